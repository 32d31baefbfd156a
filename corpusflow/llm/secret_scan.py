"""Secret scans over an incremental ledger of blobs, in DataFrame operations alone.

Every version of every path is addressed by the digest of its text (its blob). The ledger knows
which blobs were scanned by which version of which rule, so a batch scans a text only for pairs of
blob and rule version that are new, once for all its copies; findings are stored by blob and
joined back to all paths that ever held it. A new rule version is scanned for alone.

A ledger is a folder of batches. What a batch wrote counts once its mark stands, which is written
last; a batch that broke off is written anew when it is sent again, one that stands is not.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.plans.sizing import fits_broadcast, scratch_path

from .common import let, marked, set_mark, table_in, text_or_empty


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``least`` is the length that ``group`` of a match must have."""

    kind: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 0

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


_NAMES = "|".join(_either(x) for x in ("password", "passwd", "secret", "token")) + f"|{_either('api')}_?{_either('key')}"
# A run that is too short for the second and third kind holds no longer one, so the length can
# stand in the pattern; a value that is too short still uses up its text, so there it cannot.
BASE = (
    Rule("assign", rf"""(?:{_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=1, least=6),
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
)
# Formats of keys and tokens, each of bounded length.
MORE = (
    Rule("pem", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("forge", "gh[opsur]_[A-Za-z0-9]{36}"),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]{10,48}"),
    Rule("maps", "AIza[A-Za-z0-9_-]{35}"),
)
RULES = BASE + MORE


def _matches(body: Column, rule: Rule, number: int, wanted: Column | None) -> Column:
    """Every match in order: the rule's number, its place, the text before it, its length, whether it counts."""
    whole = F.regexp_extract_all(body, F.lit(rule.pattern), F.lit(0))
    judged = F.regexp_extract_all(body, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    sized = F.zip_with(whole, judged, lambda w, v: F.struct(
        F.char_length(w).alias("len"), (F.char_length(v) >= rule.least).alias("ok")))
    # The pieces between matches tell where those stand; the last piece follows the last match.
    placed = F.zip_with(sized, F.split(body, rule.pattern, -1), lambda x, gap: F.struct(
        F.lit(number).alias("rule"), F.char_length(gap).alias("gap"), x["len"].alias("len"), x["ok"].alias("ok")))
    numbered = F.transform(placed, lambda x, k: x.withField("k", k))
    there = body.rlike(rule.pattern) if wanted is None else F.array_contains(wanted, rule.id) & body.rlike(rule.pattern)
    none = F.array().cast("array<struct<rule:int,gap:int,len:int,ok:boolean,k:int>>")
    return F.when(there, F.filter(numbered, lambda x: x["len"].isNotNull())).otherwise(none)


def scan(texts: DataFrame, rules: tuple[Rule, ...], wanted: str | None = None) -> DataFrame:
    """``(blob, rule, kind, start, end)`` of ``texts(blob, body)``; code points, end exclusive.

    ``wanted`` names a column with the ids of the rules that a text is scanned for. The places
    of a rule's matches are sums over the matches before, by a window over one text.
    """
    found = F.concat(*[_matches(F.col("body"), r, i, F.col(wanted) if wanted else None) for i, r in enumerate(rules)])
    rows = texts.withColumn("text_no", F.monotonically_increasing_id())  # before the matches become rows
    rows = rows.select("blob", "text_no", F.explode_outer(found).alias("m")).where("m IS NOT NULL")
    rows = rows.select("blob", "text_no", "m.*")
    upto = W.partitionBy("blob", "text_no", "rule").orderBy("k").rowsBetween(W.unboundedPreceding, 0)
    ends = rows.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(upto)).where("ok")
    named = lambda what: F.element_at(F.array(*[F.lit(x) for x in what]), F.col("rule") + 1)
    return ends.select("blob", named([r.id for r in rules]).alias("rule"), named([r.kind for r in rules]).alias("kind"),
                       (F.col("end") - F.col("len")).alias("start"), "end")


class Ledger:
    """Blobs, what they were scanned for, and what was found, in a folder that all executors share."""

    PATHS = "path {path}, blob binary"
    SCANNED = "blob binary, rules array<string>"
    FOUND = "blob binary, rule string, kind string, start long, end long"

    def __init__(self, spark: SparkSession, folder: str, rules: tuple[Rule, ...] = RULES):
        if len({r.kind for r in rules}) < len(rules):
            raise ValueError("a kind has one rule")
        self.spark, self.folder, self.rules = spark, folder.rstrip("/"), tuple(rules)

    def _batch(self, name: str) -> str:
        if not name or not all(c.isalnum() or c in "._-" for c in name):
            raise ValueError(f"a batch name is letters, digits, dots and dashes, not {name!r}")
        return f"{self.folder}/batch={name}"

    def scanned(self) -> DataFrame:
        """``(blob, rules)``: what has been scanned for what."""
        return table_in(self.spark, marked(self.spark, self.folder), "scanned", self.SCANNED)

    def findings(self) -> DataFrame:
        """All that was found, under any rule version, once for each blob."""
        return table_in(self.spark, marked(self.spark, self.folder), "found", self.FOUND)

    def paths(self, path: str = "long") -> DataFrame:
        """``(path, blob)`` of every version of every path."""
        return table_in(self.spark, marked(self.spark, self.folder), "paths", self.PATHS.format(path=path))

    def todo(self, paths: DataFrame) -> DataFrame:
        """``(blob, path, rules)``: new pairs of blob and rule version, with the least path that holds the blob."""
        blobs = paths.groupBy("blob").agg(F.min("path").alias("path"))
        every = F.array(*[F.lit(r.id) for r in self.rules])
        if not marked(self.spark, self.folder):
            return blobs.withColumn("rules", every)
        known = self.scanned().groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("known"))
        left = F.array_except(every, F.coalesce("known", F.array().cast("array<string>")))
        return blobs.join(known, "blob", "left").select("blob", "path", left.alias("rules")).where(F.size("rules") > 0)

    def record(self, batch: str, docs: DataFrame, path: str = "doc_id", text: str = "text") -> bool:
        """Add a batch of versions and scan what is new in it; tells whether the batch was new.

        Null texts are empty. Paths may be null and may repeat with other texts (versions).
        Texts stay in place where the rows to scan, or those to leave out, pass a size check;
        else both sides meet on (blob, path), a key that copies do not share.
        """
        folder = self._batch(batch)
        if folder in marked(self.spark, self.folder):
            return False
        rows = docs.select(F.col(path).alias("path"), text_or_empty(text).alias("body"))
        rows = rows.withColumn("blob", F.unhex(F.sha2("body", 256)))
        rows.select("path", "blob").write.mode("overwrite").parquet(f"{folder}/paths")
        paths = self.spark.read.parquet(f"{folder}/paths")
        self.todo(paths).write.mode("overwrite").parquet(f"{folder}/scanned")
        todo = self.spark.read.parquet(f"{folder}/scanned")
        same = lambda other: (F.col("blob") == other["_blob"]) & F.col("path").eqNullSafe(other["_path"])
        ask = todo.select(F.col("blob").alias("_blob"), F.col("path").alias("_path"), "rules")
        spare = paths.join(todo.select("blob", "path").distinct(), (paths["blob"] == todo["blob"]) & paths["path"].eqNullSafe(todo["path"]),
                           "left_anti").distinct().select(F.col("blob").alias("_blob"), F.col("path").alias("_path"))
        if fits_broadcast(ask, "96"):
            texts = rows.join(F.broadcast(ask), same(ask))
        elif todo.where(F.size("rules") < len(self.rules)).isEmpty() and fits_broadcast(spare, "64"):
            texts = rows.join(F.broadcast(spare), same(spare), "left_anti")
        else:
            texts = rows.join(ask, same(ask))
        found = scan(texts, self.rules, "rules" if "rules" in texts.columns else None)
        found.distinct().write.mode("overwrite").parquet(f"{folder}/found")
        set_mark(self.spark, folder)
        return True

    def report(self, paths: DataFrame) -> DataFrame:
        """``paths(path, blob, ...)`` with ``spans(start, place, kind, end)``, by start and then by kind as listed.

        Only findings of the present rule versions count.
        """
        kinds = F.array(*[F.lit(r.kind) for r in self.rules])
        found = self.findings().where(F.col("rule").isin([r.id for r in self.rules]))
        each = found.groupBy("blob").agg(F.sort_array(F.collect_set(F.struct(
            "start", F.array_position(kinds, F.col("kind")).alias("place"), "kind", "end"))).alias("spans"))
        none = F.array().cast(each.schema["spans"].dataType)
        return paths.join(each, "blob", "left").withColumn("spans", F.coalesce("spans", none))


def _told(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def secrets(docs: DataFrame) -> DataFrame:
    """Secrets of every document: counts and digest of the base kinds, and all spans.

    A null text is empty and holds none. Documents without an id, repeated rows and copies get
    the findings of their blob. Other columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    ledger = Ledger(spark, scratch_path(spark, "secret-ledger"))
    ledger.record("all", docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = ledger.report(ledger.paths(kind).withColumnRenamed("path", "doc_id"))
    n = lambda rule: F.size(F.filter("spans", lambda x: x["kind"] == rule.kind)).cast("long").alias(f"n_{rule.kind}")
    base = F.filter("spans", lambda x: x["place"] <= len(BASE))
    return rows.select("doc_id", *[n(r) for r in BASE], let(_told(base), lambda s: F.sha2(s, 256)).alias("base_sha256"), _told(F.col("spans")).alias("spans"))


def _sql() -> str:
    """The same in DuckDB, straight from the text of each row."""
    quoted = [(r, r.pattern.replace("'", "''")) for r in RULES]
    parts = " UNION ALL ".join(f"""
    SELECT row_no, {place} AS place, '{r.kind}' AS kind, {r.least} AS least, regexp_extract_all(body, '{p}', 0) AS m,
           regexp_extract_all(body, '{p}', {r.group}) AS v, string_split_regex(body, '{p}') AS gaps FROM docs""" for place, (r, p) in enumerate(quoted, 1))
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS body FROM documents),
hits AS ({parts}),
placed AS (
    SELECT row_no, place, kind, unnest(list_transform(range(1, len(m) + 1), lambda i: {{
        'start': list_sum(list_transform(gaps[1:i], lambda x: length(x)))
                 + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0),
        'len': length(m[i]), 'ok': length(v[i]) >= least}})) AS s
    FROM hits WHERE len(m) > 0),
spans AS (
    SELECT row_no, place, kind, s.start::BIGINT AS pos, kind || ':' || s.start::BIGINT || ':' || (s.start + s.len)::BIGINT AS told
    FROM placed WHERE s.ok),
each AS (
    SELECT row_no, {", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in BASE)},
           string_agg(told, ',' ORDER BY pos, place) FILTER (WHERE place <= {len(BASE)}) AS base,
           string_agg(told, ',' ORDER BY pos, place) AS spans
    FROM spans GROUP BY row_no)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN each USING (row_no)
"""


SQL = _sql()
