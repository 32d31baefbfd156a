"""Quality rules and robust multivariate outliers, in DataFrame operations alone.

Each document gives a few counts, found inside its own row. Documents that fail the plain rules
go; those that pass are compared with their like: for each language and source the minimum
covariance determinant gives a centre and a covariance that a minority of odd documents cannot
pull away, and a document too far from the centre by its Mahalanobis distance goes too.

An estimate takes concentration steps from three fixed starts: fit to the ``SUBSET`` share of rows
that are nearest, and again. The start with the least determinant goes on until the determinant
falls no more. Every estimate is drawn towards the medians and deviations of its language by
``PRIOR_ROWS`` rows of weight, so groups of any size are judged by one rule. Quantiles come from histograms and moments from sums, so a step is a pair
of combined aggregates, whatever a group's size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.plans.sizing import broadcast_if_small

from .common import let, stored, text_or_empty

SUBSET = 0.75        # share of a group's rows that its estimate fits
CHI_SUBSET = 6.6257  # quantile of the chi-squared distribution of five degrees at SUBSET
CUTOFF = 35.888      # its quantile at 0.999999: squared distance over which a document is an outlier
PRIOR_ROWS = 60      # rows that the normal distribution of the language weighs in a group
STEPS = 2            # concentration steps of each start
MORE_STEPS = 3       # at most, of the best start
LEAST_FALL = 0.05    # of the logarithm of the determinant, for a further step
# Transformed statistics, and the spread each is granted at least, so that a statistic that is
# the same for nearly all documents of a group is no trap for the others.
STATS = ("word_length", "symbols", "duplicates", "repeats", "capitals")
FLOOR = (0.05, 0.04, 0.15, 0.08, 0.05)
BINS = 256           # histogram bins of a unit

DIM = range(len(STATS))


def _repeated(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more, from the sorted windows."""
    def windows(w: Column) -> Column:
        hashed = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(
            F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))
        return F.when(F.size(w) >= 3, F.sort_array(hashed)).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))

    def twice(g: Column) -> Column:
        hit = F.filter(g, lambda x, k:
                       F.coalesce(F.get(g, k + 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(g, k - 1)["h"] == x["h"], F.lit(False)))
        return F.sort_array(F.transform(hit, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    return let(windows(words), lambda g: let(twice(g), covered))


def counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The base counts of every document, with the statistics derived from them."""
    blank = r"[\x20\x09-\x0D]+"
    body = text_or_empty(text)
    words = F.filter(F.split("body", blank), lambda w: w != "")
    lines = F.filter(F.split("body", "\n"), lambda x: F.translate(x, " \t\x0b\x0c\r", "") != "")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(source).alias("source"), body.alias("body"))
    found = let(words, lambda w: F.struct(F.size(w).alias("n_words"), _repeated(w).alias("n_repeat_words")))
    dup = let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    rows = rows.select(
        "doc_id", "lang", "source", found.alias("w"), dup.alias("l"),
        F.char_length(F.translate("body", " \t\n\x0b\x0c\r", "")).alias("word_chars"),
        (F.char_length("body") - F.char_length(F.translate("body", "#*$%&|<>", ""))).alias("n_symbols"),
        F.regexp_count("body", F.lit(r"\p{Lu}")).alias("n_capitals"))
    n, chars = F.col("n_words"), F.greatest("word_chars", F.lit(1))
    rows = rows.select("doc_id", "lang", "source", "w.n_words", "w.n_repeat_words", "l.n_lines", "l.n_dup_lines", "word_chars",
                       "n_symbols", "n_capitals")
    return rows.select(
        "doc_id", "lang", "source", *[F.col(c).cast("long").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        ((n < 50) | (100 * F.col("n_repeat_words") > 50 * n)).alias("base_failed"),
        F.log(chars / F.greatest(n, F.lit(1))).alias("word_length"), F.sqrt(F.col("n_symbols") / chars).alias("symbols"),
        F.sqrt(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))).alias("duplicates"),
        (F.col("n_repeat_words") / F.greatest(n, F.lit(1))).alias("repeats"), F.sqrt(F.col("n_capitals") / chars).alias("capitals"))


def _quantile(rows: DataFrame, keys: list[str], value: Column, share: float, name: str) -> DataFrame:
    """Upper edge of the histogram bin at which ``share`` of a group's rows is reached."""
    bins = rows.groupBy(*keys, F.floor(value * BINS).alias("_bin")).agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(W.partitionBy(*keys).orderBy("_bin"))
    every = F.sum("_n").over(W.partitionBy(*keys))
    bins = bins.withColumn("_in", upto >= share * every)
    return bins.where("_in").groupBy(*keys).agg(((F.min("_bin") + 1) / BINS).alias(name))


def _coordinates(rows: DataFrame, value) -> DataFrame:
    """Median of each coordinate of each group, as an array ``m``."""
    long = rows.select("g", F.posexplode(F.array(*[value(i) for i in DIM])).alias("k", "x"))
    medians = _quantile(long, ["g", "k"], F.col("x"), 0.5, "m")
    return medians.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("k", "m"))).alias("m")).select("g", F.col("m.m").alias("m"))


def _x(i: int) -> Column:
    return F.col(STATS[i])


def _total(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms, F.lit(0.0))


PAIRS = [(i, j) for i in DIM for j in DIM if j <= i]


def _model(moments: DataFrame, keys: list[str]) -> DataFrame:
    """``moments(keys, c0.., e0_0..)`` with the inverse Cholesky factor ``w`` of the covariance and its log-determinant."""
    spread = [F.col(f"e{i}_{j}") - F.col(f"c{i}") * F.col(f"c{j}") for i, j in PAIRS]
    out = moments.select("*", *[(F.greatest(v, F.lit(0.0)) + F.lit(FLOOR[i] ** 2) if i == j else v).alias(f"v{i}_{j}")
                                for v, (i, j) in zip(spread, PAIRS, strict=True)])
    for i, j in PAIRS:  # Cholesky factor, row by row
        rest = F.col(f"v{i}_{j}") - _total([F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)])
        out = out.withColumn(f"l{i}_{j}", F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / F.col(f"l{j}_{j}"))
    for i, j in PAIRS:  # and its inverse
        out = out.withColumn(f"w{i}_{j}", (F.lit(1.0) if i == j else -_total(
            [F.col(f"l{i}_{k}") * F.col(f"w{k}_{j}") for k in range(j, i)])) / F.col(f"l{i}_{i}"))
    return out.select(*moments.columns, *[f"w{i}_{j}" for i, j in PAIRS], _total([2 * F.log(f"l{i}_{i}") for i in DIM]).alias("log_det"))


def _moments(rows: DataFrame, prior: DataFrame | None = None, keys: tuple[str, ...] = ("g",)) -> DataFrame:
    """Model of each group's rows, with ``PRIOR_ROWS`` more that have the moments ``prior(g, c0.., e0_0..)``."""
    sums = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.sum(_x(i)).alias(f"s{i}") for i in DIM],
                                   *[F.sum(_x(i) * _x(j)).alias(f"s{i}_{j}") for i, j in PAIRS])
    names = [(f"s{i}", f"c{i}") for i in DIM] + [(f"s{i}_{j}", f"e{i}_{j}") for i, j in PAIRS]
    if prior is None:
        means = [(F.col(a) / F.col("n")).alias(b) for a, b in names]
    else:
        sums = sums.join(broadcast_if_small(prior.select("g", *[F.col(b).alias(f"p_{b}") for _, b in names]), "200"), "g")
        means = [((F.col(a) + PRIOR_ROWS * F.col(f"p_{b}")) / (F.col("n") + PRIOR_ROWS)).alias(b) for a, b in names]
    return stored(_model(sums.select(*keys, *means), list(keys)), "mcd")


def _distance() -> Column:
    sides = [_total([F.col(f"w{i}_{j}") * (_x(j) - F.col(f"c{j}")) for j in range(i + 1)]) for i in DIM]
    return _total([s * s for s in sides])


def _scale(d: Column) -> Column:
    return F.log1p(d)


def _measured(data: DataFrame, model: DataFrame) -> DataFrame:
    """``(g, start, STATS, d)``: squared distance of each row to every model of its group."""
    return data.join(broadcast_if_small(model, "320"), "g").select("g", "start", *STATS, _distance().alias("d"))


def _step(data: DataFrame, current: DataFrame, prior: DataFrame) -> DataFrame:
    """Models of the ``SUBSET`` share of rows that are nearest to each current one."""
    near = stored(_quantile(current, ["g", "start"], _scale(F.col("d")), SUBSET, "edge"), "edges")
    chosen = current.join(broadcast_if_small(near), ["g", "start"]).where(_scale(F.col("d")) < F.col("edge"))
    return _moments(chosen, prior, ("g", "start"))


def _deviations(data: DataFrame) -> DataFrame:
    """``(g, m, mad)``: median and median deviation of each coordinate."""
    medians = stored(_coordinates(data, _x), "medians")
    centred = data.join(broadcast_if_small(medians, "160"), "g")
    spreads = _coordinates(centred, lambda i: F.abs(_x(i) - F.col("m")[i])).withColumnRenamed("m", "mad")
    return stored(medians.join(spreads, "g"), "spreads")


def estimates(data: DataFrame, prior: DataFrame) -> DataFrame:
    """Model, ``log_det`` and consistency ``factor`` of each group ``g`` of ``data(g, *STATS)``.

    ``prior`` holds for each group the model that it is drawn to. The starts are the sum and the
    largest of the squared coordinate deviations, and the distance to the prior's model.
    """
    start = data.join(broadcast_if_small(_deviations(data), "200"), "g").join(broadcast_if_small(prior, "320"), "g")
    z = [(_x(i) - F.col("m")[i]) / (1.4826 * F.col("mad")[i] + F.lit(FLOOR[i])) for i in DIM]
    ways = F.array(_total([c * c for c in z]), F.greatest(*[c * c for c in z]), _distance())
    current = start.select("g", *STATS, F.posexplode(ways).alias("start", "d"))
    for _ in range(STEPS):
        models = _step(data, current, prior)
        current = _measured(data, models)
    every = [c for c in models.columns if c != "g"]
    best = stored(models.groupBy("g").agg(F.min(F.struct("log_det", *[c for c in every if c != "log_det"])).alias("m")).select(
        "g", *[F.col(f"m.{c}").alias(c) for c in every]), "mcd")
    for _ in range(MORE_STEPS):
        new = _step(data, _measured(data, best), prior)
        fell = new.select("g", F.struct(*every).alias("new")).join(best.select("g", F.struct(*every).alias("old")), "g").withColumn(
            "fell", F.col("old.log_det") - F.col("new.log_det") > LEAST_FALL)
        fell = stored(fell.select("g", "fell", F.when(F.col("fell"), F.col("new")).otherwise(F.col("old")).alias("m")), "mcd")
        best = fell.select("g", *[F.col(f"m.{c}").alias(c) for c in every])
        if fell.where("fell").isEmpty():
            break
    # Consistency: at a normal distribution the subset's edge is the chi-squared quantile.
    last = _measured(data, best)
    edge = _quantile(last, ["g"], _scale(F.col("d")), SUBSET, "edge").join(last.groupBy("g").agg(F.count(F.lit(1)).alias("n")), "g")
    edge = edge.join(prior.select("g", F.col("factor").alias("p_factor")), "g")
    own = F.greatest(F.expm1("edge") / CHI_SUBSET, F.lit(1.0))
    factor = (F.col("n") * own + PRIOR_ROWS * F.col("p_factor")) / (F.col("n") + PRIOR_ROWS)
    return stored(best.drop("start").join(edge.select("g", factor.alias("factor")), "g"), "mcd")


def outlier_distances(rows: DataFrame) -> DataFrame:
    """``(row columns, distance)`` of ``rows(lang_key, g, *STATS, ...)`` to the estimate of their group ``g``."""
    data = rows.select("lang_key", "g", *STATS)
    told = _deviations(data.select(F.col("lang_key").alias("g"), *STATS)).withColumnRenamed("g", "lang_key")
    groups = data.select("lang_key", "g").distinct().join(broadcast_if_small(told, "200"), "lang_key")
    normal = groups.select("g", *[F.col("m")[i].alias(f"c{i}") for i in DIM], *[
        (F.col("m")[i] * F.col("m")[j] + (F.pow(1.4826 * F.col("mad")[i], F.lit(2.0)) if i == j else F.lit(0.0))).alias(f"e{i}_{j}")
        for i, j in PAIRS])
    prior = stored(_model(normal, ["g"]).withColumn("factor", F.lit(1.0)), "prior")
    model = estimates(data.select("g", *STATS), prior)
    return rows.join(broadcast_if_small(model, "320"), "g").select(
        *[F.col(f"`{c}`") for c in rows.columns], (_distance() / F.col("factor")).alias("distance"))


def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
           cutoff: float = CUTOFF) -> DataFrame:
    """Counts, ``base_failed``, ``distance`` and ``kept`` of every document.

    Null and blank texts have no words and fail the base rules; ``distance`` is null for rows that
    fail. Null languages and sources are groups like others, and so are groups of one row.
    Repeated rows are judged alike, ties of distance too; other columns are not read.
    """
    rows = stored(counts(docs, doc_id, text, lang, source).withColumns({
        "lang_key": F.xxhash64("lang"), "g": F.xxhash64("lang", "source", F.lit(1))}), "quality")
    near = outlier_distances(rows.where(~F.col("base_failed")))
    out = near.unionByName(rows.where("base_failed").withColumn("distance", F.lit(None).cast("double")))
    kept = ~F.col("base_failed") & (F.col("distance") <= cutoff)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      F.coalesce(kept, F.lit(False)).alias("kept"), "distance")
