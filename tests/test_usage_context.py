import json

from pyspark.sql import functions as F

from corpusflow.operators import context as X
from corpusflow.operators import usage as G
from corpusflow.streaming import jobs

# Three logged requests and their summary.
LOGGED = [(190.98, 43, 9), (111.59, 46, 13), (335.82, 45, 196)]


def telemetry(spark, failures=()):
    rows = [(i, ms, p, c, p + c, "SUCCESS") for i, (ms, p, c) in enumerate(LOGGED)]
    rows += [(10 + i, ms, 0, 0, 0, "FAILED: TimeoutError") for i, ms in enumerate(failures)]
    return spark.createDataFrame(rows, "request_id bigint, latency_ms double, prompt_tokens bigint, "
                                       "completion_tokens bigint, total_tokens bigint, status string")


def test_golden_summary(spark):
    assert tuple(G.health(telemetry(spark)).first()) == (3, 0, "0.00%", 212.8, 352, 117.33)


def test_failures_count_latency_and_no_tokens(spark):
    row = G.health(telemetry(spark, [100.0])).first()
    assert (row.total_requests_processed, row.total_exceptions_raised, row.system_error_rate) == (4, 1, "25.00%")
    assert row.average_response_latency_ms == 184.6 and row.average_tokens_per_payload == 88.0


def test_the_mean_is_rounded_and_not_its_parts(spark):
    started = "timestamp'2024-01-01 00:00:00'"
    requests = spark.range(3).selectExpr(
        "id AS request_id", f"{started} AS started", f"timestamp_micros(unix_micros({started}) + 1004) AS stopped", "CAST(NULL AS string) AS failure",
        "1L AS prompt_tokens", "1L AS completion_tokens", "'m' AS model_name")
    rows = G.telemetry(requests, "none")
    assert {r.latency_ms for r in rows.collect()} == {1.0} and G.health(rows).first().average_response_latency_ms == 1.0
    slower = G.telemetry(requests.withColumn("stopped", F.expr(f"timestamp_micros(unix_micros({started}) + IF(request_id = 0, 1008, 1004))")), "none")
    assert G.health(slower).first().average_response_latency_ms == 1.01  # 1.00533; the mean of 1.01, 1.0, 1.0 is 1.00333


def test_empty_table_divides_by_one(spark):
    row = G.health(telemetry(spark).limit(0)).first()
    assert tuple(row) == (0, 0, "0.00%", 0.0, 0, 0.0)


def test_stream_of_two_files_ends_at_the_batch_summary(spark, tmp_path):
    df = telemetry(spark, [50.0])
    for n in (0, 1):
        df.where(F.col("request_id") % 2 == n).coalesce(1).write.parquet(str(tmp_path / "in" / f"p{n}"))
    stream = (spark.readStream.schema(df.schema).option("recursiveFileLookup", True)
              .option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")))
    assert jobs.running_health(stream, str(tmp_path / "out")).first() == G.health(df).first()


def test_preflight_limit_is_inclusive(spark):
    df = spark.createDataFrame([(" ".join(["w"] * n),) for n in (38, 39)] + [("  ",)], "text string")
    rows = G.preflight(df, 50).collect()
    assert [(r.estimated_tokens, r.allowed) for r in rows] == [(50, True), (51, False), (0, True)]
    assert rows[1].reason == "Blocked: Query estimation (51 tokens) exceeds budget cap (50)."


def test_usage_defaults_to_zero(spark):
    df = spark.createDataFrame([('{"token_usage":{"prompt_tokens":7}}',), ("{}",), (None,)], "response string")
    assert [tuple(r) for r in df.select(*G.usage_columns()).collect()] == [
        (7, 0, "unknown-model"), (0, 0, "unknown-model"), (0, 0, "unknown-model")]


def test_routes_and_costs(spark):
    df = spark.createDataFrame([("  COMPLEX\n",), ("it is complex.",), ("simple",), ("",)], "d string")
    assert [r.t for r in df.select(G.route("d").alias("t")).collect()] == ["complex", "complex", "simple", "simple"]
    usage = spark.createDataFrame([("simple", 1_000_000, 500_000), ("complex", 10, 0)],
                                  "tier string, prompt_tokens bigint, completion_tokens bigint")
    cost = {r.tier: r.total_cost for r in G.cost_by_tier(usage, G.price_table(spark)).collect()}
    assert cost == {"simple": 0.09, "complex": 0.000006}


def test_log_payload_wins_over_base_fields(spark):
    df = spark.createDataFrame([("S", 1.5)], "status string, latency_ms double")
    line = G.log_lines(df, {"status": F.lit("BASE"), "level": F.lit("INFO")}, ["status", "latency_ms"]).first()[0]
    assert json.loads(line) == {"level": "INFO", "status": "S", "latency_ms": 1.5}


def test_tags_and_attributes(spark):
    df = spark.createDataFrame([(1, ["a", "b"], {"tier": "x"}), (2, ["a"], {})],
                               "id int, tags array<string>, attrs map<string,string>")
    assert [r.id for r in G.with_tag(df, "b").collect()] == [1]
    assert [r.id for r in G.with_attribute(df, "tier", "x").collect()] == [1]


def ranked(spark):
    rows = [(1, 2, "second {question}", "b.md", {"file_name": "b.md", "location": "Row 1"}),
            (1, 1, "first", None, {}), (1, 3, "third", "b.md", {"file_name": "b.md", "location": "Row 1"})]
    return spark.createDataFrame(rows, "query_id bigint, rank int, text string, source string, "
                                       "metadata map<string,string>")


def test_context_renderings(spark):
    df = ranked(spark)
    render = lambda line, sep: X.assemble(df, line, sep).first().context
    assert render(X.plain_line(), "\n\n") == "first\n\nsecond {question}\n\nthird"
    assert render(X.source_line(), X.SOURCE_SEPARATOR).startswith("Source (unknown): first\n---\nSource (b.md): second")
    assert render(X.numbered_line(), "\n\n").startswith("[1] Source unknown:\nfirst\n\n[2] Source b.md:\n")
    assert render(X.bracket_line(), "\n\n").endswith("[b.md]: third")


def test_prompt_leaves_marks_inside_texts_alone(spark):
    contexts = X.assemble(ranked(spark), X.plain_line(), "|")
    queries = spark.createDataFrame([(1, "why {context}?")], "query_id bigint, query string")
    prompt = X.fill_prompt(contexts, queries, "C: {context} Q: {question}!").first().prompt
    assert prompt == "C: first|second {question}|third Q: why {context}?!"


def test_attribution_is_unique_with_defaults(spark):
    rows = sorted(X.attribution(ranked(spark)).collect(), key=lambda r: r.source_no)
    assert [(r.file_name, r.file_type, r.location, r.first_rank) for r in rows] == [
        ("unknown", "unknown", "N/A", 1), ("b.md", "unknown", "Row 1", 2)]


def test_answers_decode_or_give_null(spark):
    good = '{"answer":"a","confidence":"high","sources_used":["x","y"],"follow_up":"f"}'
    df = spark.createDataFrame([(1, good), (2, "no json")], "id int, response string")
    rows = {r.id: r.parsed for r in X.parse_answers(df, schema=X.GRADED_ANSWER).collect()}
    assert rows[1].sources_used == ["x", "y"] and rows[1].confidence == "high"
    assert rows[2] is None or rows[2].answer is None


def test_compression_keeps_close_sentences_in_order(spark):
    docs = spark.createDataFrame(
        [(1, 5, 1, 0.5, "Backups run nightly. Cats sleep. Nightly backups are kept."), (1, 6, 2, 0.1, "Cats sleep.")],
        "query_id bigint, id bigint, rank int, score double, text string")
    queries = spark.createDataFrame([(1, "nightly backups")], "query_id bigint, query string")
    rows = X.compress(docs, queries, 0.3).collect()
    assert [(r.id, r.compressed) for r in rows] == [(5, "Backups run nightly. Nightly backups are kept.")]
    assert rows[0].chars_before == 58 and rows[0].chars_after == len(rows[0].compressed)


def test_malformed_counts_are_zero(spark):
    df = spark.createDataFrame([('{"token_usage":{"prompt_tokens":"n/a","completion_tokens":12.0}}',)], "response string")
    assert tuple(df.select(*G.usage_columns()).first()) == (0, 12, "unknown-model")


def test_only_answered_misses_are_billed(spark):
    df = spark.createDataFrame([(1, None, None), (2, "", None), (3, "stored", None), (4, None, "TimeoutError")],
                               "request_id bigint, cached_response string, failure string")
    assert sorted(r.request_id for r in G.answered_misses(df).collect()) == [1, 2]


def test_missing_provenance_and_text_keep_the_chunk(spark):
    df = spark.createDataFrame([(1, 1, "one", None, "Text", "p. 1"), (1, 2, None, "f", None, None)],
                               "query_id bigint, rank int, text string, file_name string, file_type string, location string")
    row = X.assemble(df, X.header_line(), "|").first()
    assert row.context == "[FILE: unknown | TYPE: Text | LOCATION: p. 1]\none|[FILE: f | TYPE: unknown | LOCATION: N/A]\n"
