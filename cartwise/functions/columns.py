"""Scalar building blocks. All are built-in column expressions (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

# Message prefix and the bound that separates epoch seconds from
# epoch milliseconds (1e11 seconds is the year 5138).
RATING_PREFIX = "PRODUCT_RATING_PREFIX:"
MILLIS_FROM = 100_000_000_000


def epoch_seconds(ts: Column) -> Column:
    """Epoch value in seconds, whichever of seconds or milliseconds came in."""
    return F.when(ts > MILLIS_FROM, F.floor(ts / 1000)).otherwise(ts).cast("bigint")


def ntz_epoch(ts: Column) -> Column:
    """Zoneless timestamp, read as UTC, to epoch seconds, whatever the session zone."""
    days = F.unix_date(F.to_date(ts)).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def yearmonth(ts: Column, tz: str = "UTC") -> Column:
    """Epoch seconds as the integer yyyyMM in ``tz``, whatever the session zone."""
    utc = F.timestamp_add("SECOND", ts, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    local = utc if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)
    return (F.year(local) * 100 + F.month(local)).cast("int")


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``changeDate(seconds)`` callable from SQL text, as a native SQL function."""
    month = "timestampadd(SECOND, ts, TIMESTAMP_NTZ'1970-01-01 00:00:00')"
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION changeDate(ts BIGINT) RETURNS INT "
        f"RETURN CAST(year({month}) * 100 + month({month}) AS INT)"
    )


def quantise(score: Column) -> Column:
    """Score on a 1e-9 grid.

    Float sums depend on the order of addition, and thus on partitioning. Lists
    are cut and ranked on the grid value, so equal scores stay equal.
    """
    return F.floor(score * 1e9 + 0.5) / 1e9


def cooccurrence_norm(n1: Column, n2: Column) -> Column:
    """Square root of the product of two counts, multiplied as doubles (no overflow)."""
    return F.sqrt(n1.cast("double") * n2)


def cooccurrence_similarity(both: Column, n1: Column, n2: Column) -> Column:
    return both / cooccurrence_norm(n1, n2)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two dense arrays; NULL (never NaN) when either has length zero."""
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def tag_text(tags: Column) -> Column:
    return F.translate(tags, "|", " ")


def tokens(text: Column) -> Column:
    """Lower-cased words, split on every single whitespace character; none at the end, none in blank text."""
    whole = F.regexp_replace(F.lower(text), r"\s+$", "")
    return F.when(whole == "", F.array().cast("array<string>")).otherwise(F.split(whole, r"\s"))


def term_bucket(term: Column, buckets: int) -> Column:
    """Hashing-trick bucket: murmur3 with seed 42, modulo the bucket count."""
    return F.pmod(F.hash(term), F.lit(buckets))


def idf(n_docs: Column, doc_freq: Column) -> Column:
    return F.ln((n_docs + 1) / (doc_freq + 1))


def half_score(score: Column) -> Column:
    """Ten-star score to five stars, two decimals."""
    return F.round(score / 2, 2)


def trim_blanks(text: Column) -> Column:
    """Text without the blanks and control characters at its ends."""
    return F.regexp_replace(text, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def rating_event(user: Column, product: Column, score: Column, ts: Column) -> Column:
    return F.concat(F.lit(RATING_PREFIX), F.concat_ws("|", user, product, score, ts))


def rating_payload(line: Column) -> Column:
    """Text between the first and second prefix, trimmed; NULL when there is none."""
    after = F.try_element_at(F.split(line, RATING_PREFIX), F.lit(2))
    return F.when(line.contains(RATING_PREFIX), F.nullif(trim_blanks(after), F.lit("")))


def exact_mean_product(sim: Column, rating: Column) -> Column:
    """Aggregate: mean of sim * rating, summed as decimals with nine places each.

    Similarities sit on that grid and ratings keep nine decimals, so the sum is
    exact and the same in any order.
    """
    product = sim.cast("decimal(11,9)") * rating.cast("decimal(18,9)")
    return F.sum(product).cast("double") / F.count("*")


def stream_score(mean_weighted: Column, high: Column, low: Column) -> Column:
    one = F.lit(1)
    return mean_weighted + (F.log10(F.greatest(one, high)) - F.log10(F.greatest(one, low)))
