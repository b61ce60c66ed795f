"""Whole jobs over a small shop: files in, result tables out."""

import random

from cartwise import schema
from cartwise.operators import itemcf, stats
from cartwise.operators.ranking import unpack_recs
from cartwise.plans import jobs
from cartwise.sources.files import read_table


def test_jobs_end_to_end(spark, tmp_path):
    rng = random.Random(4)
    words = ["red", "blue", "round", "box", "pen", "cup"]
    products = [
        f"{p}^name {p}^1,2^B{p}^http://img/{p}^c^{'|'.join(rng.sample(words, 3))}" for p in range(1, 25)
    ] + ["bad line"]
    ratings = [
        f"{rng.randrange(30)},{rng.randrange(1, 25)},{rng.randint(1, 5)}.0,{1390000000 + i * 40000}" for i in range(400)
    ] + ["1,2,x,4"]
    (tmp_path / "products.csv").write_text("\n".join(products) + "\n")
    (tmp_path / "ratings.csv").write_text("\n".join(ratings) + "\n")
    base = str(tmp_path / "tables")

    jobs.load(spark, str(tmp_path / "products.csv"), str(tmp_path / "ratings.csv"), base)
    assert spark.read.parquet(f"{base}/ProductRejects").count() == 1
    assert spark.read.parquet(f"{base}/RatingRejects").count() == 1
    rating = read_table(spark, base, "Rating", schema.RATING)
    assert rating.count() == 400

    jobs.statistics(spark, base)
    for name, table_schema, direct in (
        ("RateMoreProducts", schema.RATE_MORE, stats.rate_more_products(rating)),
        ("RateMoreRecentlyProducts", schema.RATE_MORE_RECENTLY, stats.rate_more_recently(rating)),
        ("AverageProducts", schema.AVERAGE, stats.average_products(rating)),
    ):
        written = read_table(spark, base, name, table_schema)
        assert sorted(map(tuple, written.collect())) == sorted(map(tuple, direct.select(written.columns).collect()))

    jobs.item_cf(spark, base)
    lists = read_table(spark, base, "ItemCFProductRecs", schema.PRODUCT_RECS)
    flat = unpack_recs(lists, "productId").select("productId", "rec_productId", "score", "rank")
    direct = itemcf.item_cf(rating).select(flat.columns)
    assert sorted(map(tuple, flat.collect())) == sorted(map(tuple, direct.collect()))

    jobs.content_lists(spark, base)
    jobs.offline_lists(spark, base)
    for name, table_schema in (
        ("ContentBasedProductRecs", schema.RANKED), ("ProductRecs", schema.RANKED), ("LiveLists", schema.RANKED), ("UserRecs", schema.USER_RECS),
    ):
        table = read_table(spark, base, name, table_schema)
        flat = table if table_schema is schema.RANKED else unpack_recs(table, "userId").withColumnRenamed("userId", "productId")
        lists = {}
        for row in flat.orderBy("productId", "rank").collect():
            lists.setdefault(row["productId"], []).append((row["rank"], row["score"]))
        for entries in lists.values():
            scores = [s for _, s in entries]
            assert [r for r, _ in entries] == list(range(1, len(entries) + 1)) and scores == sorted(scores, reverse=True)


def test_long_lists_are_stored_whole(spark, tmp_path):
    products = [f"{p}^name {p}^1^e^i^c^red|{'box' if p % 2 else 'pen'}" for p in range(300)] + ["999^x^1^e^i^c^other|words"]
    (tmp_path / "products.csv").write_text("\n".join(products) + "\n")
    (tmp_path / "ratings.csv").write_text("1,2,3.0,1390000000\n")
    base = str(tmp_path / "tables")
    jobs.load(spark, str(tmp_path / "products.csv"), str(tmp_path / "ratings.csv"), base)
    jobs.content_lists(spark, base, buckets=None)
    longest = read_table(spark, base, "ContentBasedProductRecs", schema.RANKED).groupBy("productId").count().agg({"count": "max"}).first()[0]
    assert longest == 149  # every other product of the same words
