import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cartwise.operators import itemcf
from cartwise.operators.itemcf import cooccurrence, item_cf
from cartwise.operators.pairs import mirror, pairs_within
from cartwise.operators.ranking import pack_recs, similarity_map, top_k, unpack_recs
from plans import executed

SCHEMA = "userId bigint, productId bigint, score double, timestamp bigint"


def _ratings(spark, pairs):
    return spark.createDataFrame([(u, p, 5.0, i) for i, (u, p) in enumerate(pairs)], SCHEMA)


def _brute(pairs, k, distinct=False):
    pairs = list(set(pairs)) if distinct else pairs
    n = Counter(p for _, p in pairs)
    by_user = defaultdict(list)
    for u, p in pairs:
        by_user[u].append(p)
    co = Counter((a, b) for ps in by_user.values() for a in ps for b in ps if a != b)
    lists = defaultdict(list)
    for (a, b), c in co.items():
        lists[a].append((b, c / math.sqrt(n[a] * n[b])))
    out = {}
    for a, recs in lists.items():
        for rank, (b, s) in enumerate(sorted(recs, key=lambda r: (-r[1], r[0]))[:k], 1):
            out[a, rank] = (b, pytest.approx(s, abs=1e-12))
    return out


def _got(df):
    return {(r["productId"], r["rank"]): (r["rec_productId"], r["score"]) for r in df.collect()}


def _hot_user_sample(seed=3):
    """A third of the rows belong to user 0, and a third to product 0; some rows repeat."""
    rng = random.Random(seed)
    pairs = [(0, rng.randrange(80)) for _ in range(150)]
    pairs += [(rng.randrange(1, 60), 0) for _ in range(150)]
    pairs += [(rng.randrange(1, 60), rng.randrange(80)) for _ in range(150)]
    return pairs


@pytest.mark.parametrize("chunk", [3, 16, 512])
@pytest.mark.parametrize("distinct", [False, True])
def test_matches_brute_force_with_hot_keys(spark, chunk, distinct):
    pairs = _hot_user_sample()
    got = _got(item_cf(_ratings(spark, pairs), k=5, distinct_users=distinct, chunk=chunk))
    assert got == _brute(pairs, 5, distinct)


@pytest.mark.parametrize("heavy,block_rows", [(5, 16), (40, 1024), (100, 16)])
@pytest.mark.parametrize("distinct", [False, True])
def test_heavy_users_by_blocks_match_brute_force(spark, heavy, block_rows, distinct):
    pairs = _hot_user_sample(7)
    ratings = _ratings(spark, pairs)
    got = _got(item_cf(ratings, k=5, distinct_users=distinct, chunk=16, heavy=heavy, block_rows=block_rows))
    assert got == _brute(pairs, 5, distinct)


def test_any_number_of_users_may_be_heavy(spark, monkeypatch):
    monkeypatch.setattr(itemcf, "USER_SLICE", 3)  # several slices in a task
    pairs = _hot_user_sample(7)
    assert _got(item_cf(_ratings(spark, pairs), k=5, heavy=0, block_rows=16)) == _brute(pairs, 5, False)


def test_wide_ids(spark):
    pairs = [(u + (1 << 33), p + (1 << 40)) for u, p in _hot_user_sample(7)]
    for heavy in (5, 10**6):
        assert _got(item_cf(_ratings(spark, pairs), k=5, heavy=heavy, block_rows=16)) == _brute(pairs, 5, False)


def test_input_order_changes_nothing(spark):
    pairs = _hot_user_sample(5)
    shuffled = pairs[::-1]
    assert _got(item_cf(_ratings(spark, pairs))) == _got(item_cf(_ratings(spark, shuffled)))


def test_duplicate_ratings_count_as_rows(spark):
    row = cooccurrence(_ratings(spark, [(1, 10), (1, 10), (1, 20)])).first()
    assert (row["p1"], row["p2"], row["cocount"], row["count1"], row["count2"]) == (10, 20, 2, 2, 1)


def test_lonely_product_has_an_empty_list(spark):
    ratings = _ratings(spark, [(1, 10), (1, 20), (2, 30)])
    packed = pack_recs(item_cf(ratings), "productId", "rec_productId", all_keys=ratings)
    recs = {r["productId"]: r["recs"] for r in packed.collect()}
    assert recs[30] == [] and [tuple(e) for e in recs[10]] == [(20, 1.0)]


def test_top_k_is_a_prefix_and_ties_go_to_the_lower_id(spark):
    df = spark.createDataFrame([(1, 9, 0.5), (1, 3, 0.5), (1, 7, 0.9)], "k int, productId int, score double")
    full = [r["productId"] for r in top_k(df, ["k"]).orderBy("rank").collect()]
    assert full == [7, 3, 9]
    assert [r["productId"] for r in top_k(df, ["k"], k=2).orderBy("rank").collect()] == full[:2]


def test_pack_and_unpack_round_trip(spark):
    ranked = item_cf(_ratings(spark, _hot_user_sample()), k=4)
    back = unpack_recs(pack_recs(ranked, "productId", "rec_productId"), "productId")
    assert _got(back) == _got(ranked)


def test_pairs_meet_once_whatever_the_chunking(spark):
    rows = spark.createDataFrame([(1, i) for i in range(25)] + [(2, i) for i in range(3)], "k int, i int")
    for chunk in (4, 100):
        pairs = [(r["k"], r["a"]["id"], r["b"]["id"]) for r in pairs_within(rows, "k", "i", [], chunk).collect()]
        assert len(pairs) == len(set(pairs)) == 25 * 24 // 2 + 3
        assert all(a < b for _, a, b in pairs)


def test_mirror_and_map(spark):
    sim = mirror(spark.createDataFrame([(1, 2, 0.5, 7, 8)], "p1 int, p2 int, score double, c1 int, c2 int"),
                 swap=(("c1", "c2"),))
    assert sorted(map(tuple, sim.collect())) == [(1, 2, 0.5, 7, 8), (2, 1, 0.5, 8, 7)]
    assert {r["p1"]: r["similar"] for r in similarity_map(sim, 5).collect()} == {1: {2: 0.5}, 2: {1: 0.5}}


def _counts(df):
    return {(r["p1"], r["p2"]): (r["cocount"], r["count1"], r["count2"]) for r in df.collect()}


def test_no_pair_is_shuffled(spark):
    for df in (item_cf(_ratings(spark, _hot_user_sample()), k=5), cooccurrence(_ratings(spark, _hot_user_sample()))):
        assert "Exchange" not in executed(df).split("MapInArrow")[0]  # nothing moves once pairs are made


@pytest.mark.parametrize("chunk", [7, 512])
def test_many_parts_and_spread_raters(spark, monkeypatch, chunk):
    pairs = [(u, p - 40 if p % 2 else p + (1 << 45)) for u, p in _hot_user_sample(9)]
    plain = _counts(cooccurrence(_ratings(spark, pairs)))
    for name, value in (("PART_PAIRS", 90), ("SLICE_PAIRS", 50), ("RATERS", 6), ("USER_SLICE", 4)):
        monkeypatch.setattr(itemcf, name, value)
    assert _got(item_cf(_ratings(spark, pairs), k=5, chunk=chunk)) == _brute(pairs, 5)
    assert _counts(cooccurrence(_ratings(spark, pairs), chunk=chunk)) == plain


@pytest.mark.parametrize("far", [0, 1 << 31, (1 << 62) + 5])
def test_parts_that_take_turns_give_the_same(spark, monkeypatch, far):
    pairs = [(u, p - far if p % 3 else p + far) for u, p in _hot_user_sample(9)]
    plain = _counts(cooccurrence(_ratings(spark, pairs)))
    for name, value in (("PART_PAIRS", 90), ("SLICE_PAIRS", 50), ("ROUND_PAIRS", 4000), ("DENSE_IDS", 50 if far else 1 << 20)):
        monkeypatch.setattr(itemcf, name, value)
    made = item_cf(_ratings(spark, pairs), k=5)
    assert executed(made).count("Scan parquet") > 1
    assert _got(made) == _brute(pairs, 5)
    assert _counts(cooccurrence(_ratings(spark, pairs))) == plain


def test_what_a_stored_table_shuffled_is_deleted(spark):
    from cartwise.sources.scratch import stored

    def kept():
        return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()

    before = kept()
    table = stored(spark.range(1000).groupBy(F.col("id") % 7).count())
    assert kept() == before and table.count() == 7
