import pytest
from pyspark.sql import functions as F

from cartwise.functions import columns as C


def _one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_yearmonth_at_a_month_end(spark):
    last_second = 1396310399  # 2014-03-31 23:59:59 UTC
    row = _one(
        spark,
        C.yearmonth(F.lit(last_second)).alias("utc"),
        C.yearmonth(F.lit(last_second + 1)).alias("next"),
        C.yearmonth(F.lit(last_second), "Asia/Shanghai").alias("east"),
    )
    assert tuple(row) == (201403, 201404, 201404)


def test_yearmonth_does_not_follow_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        C.register_sql_functions(spark)
        row = spark.sql("SELECT changeDate(1396310400) AS sql").select("sql", C.yearmonth(F.lit(1396310400))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(row) == (201404, 201404)


def test_epoch_seconds_takes_millis(spark):
    row = _one(spark, C.epoch_seconds(F.lit(1395676800)), C.epoch_seconds(F.lit(1395676800123)))
    assert tuple(row) == (1395676800, 1395676800)


def test_half_score(spark):
    assert tuple(_one(spark, C.half_score(F.lit(9.0)), C.half_score(F.lit(7.25)))) == (4.5, 3.63)


def test_tokens_keep_inner_blanks_and_drop_trailing_ones(spark):
    row = _one(spark, C.tokens(C.tag_text(F.lit("Red|BIG||box|"))))
    assert row[0] == ["red", "big", "", "box"]


def test_cosine_of_zero_vector_is_null_not_nan(spark):
    a, z = F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(0.0), F.lit(0.0))
    row = _one(spark, C.cosine(a, z).alias("z"), F.round(C.cosine(a, a), 9).alias("s"))
    assert row["z"] is None and row["s"] == 1.0


def test_cooccurrence_similarity_does_not_overflow(spark):
    big = F.lit(4_000_000_000)
    assert _one(spark, C.cooccurrence_similarity(big, big, big))[0] == 1.0


def test_payload(spark):
    lines = [
        ("no prefix here", None),
        ("x PRODUCT_RATING_PREFIX: 1|2|3.0|4 ", "1|2|3.0|4"),
        ("PRODUCT_RATING_PREFIX:a PRODUCT_RATING_PREFIX:b", "a"),
        ("PRODUCT_RATING_PREFIX:", None),
        ("PRODUCT_RATING_PREFIX:   ", None),
    ]
    got = spark.createDataFrame(lines, "value string, want string").select(
        "want", C.rating_payload(F.col("value")).alias("got")
    )
    assert all(r["want"] == r["got"] for r in got.collect())


def test_term_bucket_is_seed_42_murmur3(spark):
    row = _one(spark, C.term_bucket(F.lit("abcd"), 800), C.term_bucket(F.lit("鼠标"), 800))
    # murmur3 x86 32, seed 42, of b"abcd" is -396302900.
    assert row[0] == -396302900 % 800
    assert 0 <= row[1] < 800


def test_blank_text_has_no_words_and_control_blanks_are_trimmed(spark):
    from cartwise.functions.columns import tokens, trim_blanks

    frame = spark.createDataFrame([("  ",), ("",), ("a  b ",), ("\t",)], "t string")
    assert [r[0] for r in frame.select(tokens(F.col("t"))).collect()] == [[], [], ["a", "", "b"], []]
    frame = spark.createDataFrame([("\t a b\r\n",), (" x",)], "t string")
    assert [r[0] for r in frame.select(trim_blanks(F.col("t"))).collect()] == ["a b", " x"]


def test_means_keep_three_decimals(spark):
    from cartwise.functions.columns import exact_mean_product

    frame = spark.createDataFrame([(1.0, 3.337), (0.5, 2.001)], "s double, r double")
    assert frame.select(exact_mean_product(F.col("s"), F.col("r"))).first()[0] == pytest.approx((3.337 + 1.0005) / 2, abs=1e-12)
