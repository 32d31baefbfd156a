"""Token, cost, routing, cache and latency figures over request tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import word_count
from ..plans.ranking import number_rows
from ..plans.sizing import broadcast_if_small

# Tokens per word, prices per million tokens of the two tiers, message formats.
TOKENS_PER_WORD = 1.33
PRICES = [("simple", "llama-3.1-8b", 0.05, 0.08), ("complex", "llama-3.3-70b", 0.59, 0.79)]
UNKNOWN_MODEL = "unknown-model"
BLOCKED = "Blocked: Query estimation (%d tokens) exceeds budget cap (%d)."


def token_estimate(text) -> Column:
    """Words times a constant, truncated."""
    return (word_count(text) * F.lit(TOKENS_PER_WORD)).cast("int")


def preflight(requests: DataFrame, budget: int, text: str = "text") -> DataFrame:
    """Budget verdict before a request is sent; the limit itself is allowed."""
    checked = requests.withColumn("estimated_tokens", token_estimate(text))
    allowed = F.col("estimated_tokens") <= budget
    reason = F.format_string(BLOCKED, "estimated_tokens", F.lit(budget))
    return checked.withColumn("allowed", allowed).withColumn("reason", F.when(~allowed, reason))


def usage_columns(response: str = "response") -> list[Column]:
    """Token counts and model of a stored response; absent and malformed counts are zero."""
    def number(path):
        return F.coalesce(F.get_json_object(response, path).try_cast("decimal(38,6)").try_cast("bigint"), F.lit(0).cast("bigint"))

    return [number("$.token_usage.prompt_tokens").alias("prompt_tokens"),
            number("$.token_usage.completion_tokens").alias("completion_tokens"),
            F.coalesce(F.get_json_object(response, "$.model_name"), F.lit(UNKNOWN_MODEL)).alias("model_name")]


def usage_summary(usage: DataFrame) -> DataFrame:
    total = F.col("total_input_tokens") + F.col("total_output_tokens")
    sums = usage.agg(
        F.coalesce(F.sum("prompt_tokens"), F.lit(0)).alias("total_input_tokens"),
        F.coalesce(F.sum("completion_tokens"), F.lit(0)).alias("total_output_tokens"),
        F.count(F.lit(1)).alias("successful_requests"))
    return sums.withColumn("cumulative_tokens_used", total).withColumn(
        "avg_tokens_per_call",
        F.round(F.col("cumulative_tokens_used") / F.greatest("successful_requests", F.lit(1)), 2))


def price_table(spark) -> DataFrame:
    return spark.createDataFrame(PRICES, "tier string, price_model string, input_price double, output_price double")


def _is_hit() -> Column:
    """An empty cached answer is a miss."""
    return F.coalesce(F.col("cached_response") != "", F.lit(False))


def answered_misses(requests: DataFrame) -> DataFrame:
    """Requests that cost money: a cache hit calls no model, a failed call is not billed."""
    return requests.where(~_is_hit() & F.col("failure").isNull())


def cost_by_tier(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Cost per tier. Tokens are summed as integers first, so money does not depend on row order."""
    sums = usage.groupBy("tier").agg(
        F.count(F.lit(1)).alias("requests"), F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"))
    priced = sums.join(broadcast_if_small(prices), "tier")
    spent_in = F.col("prompt_tokens") / F.lit(1e6) * F.col("input_price")
    spent_out = F.col("completion_tokens") / F.lit(1e6) * F.col("output_price")
    return priced.select(
        "tier", "price_model", "requests", "prompt_tokens", "completion_tokens",
        F.round(spent_in, 6).alias("input_cost"), F.round(spent_out, 6).alias("output_cost"),
        F.round(spent_in + spent_out, 6).alias("total_cost"))


def route(decision) -> Column:
    """A classifier's free-text decision to a tier."""
    text = F.lower(F.trim(F.col(decision) if isinstance(decision, str) else decision))
    return F.when(text.contains("complex"), F.lit("complex")).otherwise(F.lit("simple"))


def cache_and_route_counts(requests: DataFrame) -> DataFrame:
    """Hits and misses, and tiers of the misses. An empty cached answer is a miss."""
    return requests.withColumn("_hit", _is_hit()).agg(
        F.count_if(F.col("_hit")).alias("cache_hits"),
        F.count_if(~F.col("_hit")).alias("cache_misses"),
        F.count_if(~F.col("_hit") & (F.col("tier") == "simple")).alias("routed_simple"),
        F.count_if(~F.col("_hit") & (F.col("tier") == "complex")).alias("routed_complex"))


def telemetry(requests: DataFrame, failed_model: str) -> DataFrame:
    """Request rows: ``request_id, started, stopped, failure`` and usage columns in.

    A failed request keeps its latency and counts no tokens. ``latency_ms`` is shown with two
    digits; sums take ``latency_micros``.
    """
    failed = F.col("failure").isNotNull()
    micros = F.unix_micros("stopped") - F.unix_micros("started")
    zero = F.lit(0).cast("bigint")
    rows = requests.select(
        "request_id", F.col("started").alias("ts"), F.round(micros / F.lit(1000.0), 2).alias("latency_ms"), micros.alias("latency_micros"),
        F.when(failed, zero).otherwise(F.col("prompt_tokens")).alias("prompt_tokens"),
        F.when(failed, zero).otherwise(F.col("completion_tokens")).alias("completion_tokens"),
        F.when(failed, F.lit(failed_model)).otherwise(F.col("model_name")).alias("model_name"),
        F.when(failed, F.concat(F.lit("FAILED: "), "failure")).otherwise(F.lit("SUCCESS")).alias("status"))
    return rows.withColumn("total_tokens", F.col("prompt_tokens") + F.col("completion_tokens"))


def number_requests(rows: DataFrame) -> DataFrame:
    """Requests numbered from 1 in time order, over the whole table."""
    return number_rows(rows, [F.asc("ts"), F.asc("request_id")], name="request_no")


def health_totals(rows: DataFrame) -> list[Column]:
    """Additive totals of telemetry rows; a sum of whole microseconds is exact.

    Rows from elsewhere may have ``latency_ms`` alone, which is then taken to the microsecond.
    """
    micros = F.col("latency_micros") if "latency_micros" in rows.columns else F.round(F.col("latency_ms") * 1000).cast("bigint")
    return [F.count(F.lit(1)).alias("requests"),
            F.count_if(F.col("status").startswith("FAILED")).alias("failures"),
            F.coalesce(F.sum(micros), F.lit(0)).alias("latency_sum"),
            F.coalesce(F.sum("total_tokens"), F.lit(0)).alias("tokens")]


def health_report(totals: DataFrame) -> DataFrame:
    n = F.greatest("requests", F.lit(1))
    return totals.select(
        F.col("requests").alias("total_requests_processed"),
        F.col("failures").alias("total_exceptions_raised"),
        F.format_string("%.2f%%", F.col("failures") / n * 100).alias("system_error_rate"),
        F.round(F.col("latency_sum") / F.lit(1000.0) / n, 2).alias("average_response_latency_ms"),
        F.col("tokens").alias("cumulative_tokens_consumed"),
        F.round(F.col("tokens") / n, 2).alias("average_tokens_per_payload"))


def health(rows: DataFrame) -> DataFrame:
    return health_report(rows.agg(*health_totals(rows)))


def log_lines(rows: DataFrame, base: dict[str, Column], payload: list[str]) -> DataFrame:
    """JSON log lines: base fields, then payload fields, which win on equal names."""
    names = [c for c in base if c not in payload]
    fields = [base[c].alias(c) for c in names] + [F.col(c) for c in payload]
    return rows.select(F.to_json(F.struct(*fields)).alias("value"))


def with_tag(runs: DataFrame, tag: str) -> DataFrame:
    return runs.where(F.array_contains("tags", tag))


def with_attribute(runs: DataFrame, name: str, value: str) -> DataFrame:
    return runs.where(F.try_element_at("attrs", F.lit(name)) == value)
