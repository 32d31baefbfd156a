import random

from pyspark.sql import functions as F

from corpusflow.plans.ranking import explode_list, number_rows, top_k


def test_numbering_of_a_hot_group_with_ties(spark):
    random.seed(1)
    rows = [("hot" if i % 3 else f"g{i % 7}", random.randint(0, 3), i) for i in range(2000)]
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v int, id bigint").repartition(5)
    done = number_rows(df, [F.desc("v"), F.asc("id")], by=["g"]).collect()
    by_group = {}
    for g, v, i in rows:
        by_group.setdefault(g, []).append((-v, i))
    expected = {i: n for group in by_group.values() for n, (_, i) in enumerate(sorted(group), 1)}
    assert {r.id: r["rank"] for r in done} == expected


def test_numbering_of_the_whole_table(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("id"))
    assert {r.id: r.n for r in number_rows(df, [F.asc("id")], name="n").collect()} == {
        i: i + 1 for i in range(1000)}


def test_top_k_is_limited_before_the_shuffle(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 3)
    plan = top_k(df, 2, ["g"], [F.desc("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_exploding_a_list_computes_it_once(spark):
    df = spark.createDataFrame([(1, "a b"), (2, ""), (3, None)], "id int, t string")
    out = explode_list(df, ["id"], F.filter(F.split("t", " "), lambda w: w != ""), "w", "n")
    assert sorted(map(tuple, out.collect())) == [(1, 0, "a"), (1, 1, "b")]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
