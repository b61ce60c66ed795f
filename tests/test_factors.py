import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwise.operators import alternating
from cartwise.operators import products
from cartwise.operators import factors
from cartwise.operators.products import Catalogue
from cartwise.plans import catalog
from plans import executed

SCHEMA = "userId int, productId int, score double, timestamp bigint"


@pytest.fixture(scope="module")
def ratings(spark):
    """Scores of rank one: user taste times product quality, plus a little noise."""
    rng = random.Random(1)
    taste = [rng.uniform(0.5, 1.5) for _ in range(40)]
    quality = [rng.uniform(1, 3) for _ in range(30)]
    rows = [
        (u, p, taste[u] * quality[p] + rng.uniform(-0.05, 0.05), u)
        for u in range(40) for p in range(30) if rng.random() < 0.6
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def model(ratings):
    return factors.train_als(ratings)


def test_fit_is_close(ratings, model):
    assert factors.rmse(factors.predictions(model, ratings)).first()["rmse"] < 0.2


def test_user_lists_are_short_positive_and_descending(model):
    lists = {}
    for r in factors.user_recs(model, k=7).collect():
        lists.setdefault(r["userId"], []).append((r["rank"], r["score"]))
    assert len(lists) == 40
    for entries in lists.values():
        entries.sort()
        assert [rank for rank, _ in entries] == list(range(1, len(entries) + 1)) and len(entries) <= 7
        scores = [s for _, s in entries]
        assert scores == sorted(scores, reverse=True) and scores[-1] > 0


def test_user_list_is_the_head_of_all_predictions(ratings, model):
    one = ratings.select("userId").filter("userId = 3").distinct()
    every = one.join(ratings.select("productId").distinct(), how="cross")
    scores = {r["productId"]: r["prediction"] for r in factors.predictions(model, every).collect()}
    best = sorted((p for p in scores if scores[p] > 0), key=lambda p: -scores[p])[:5]
    got = factors.user_recs(model, k=5).filter("userId = 3").orderBy("rank").collect()
    assert [r["rec_productId"] for r in got] == best


def test_rated_products_are_not_offered(ratings, model):
    rated = {(r["userId"], r["productId"]) for r in ratings.collect()}
    every = ratings.select("userId").distinct().join(ratings.select("productId").distinct(), how="cross")
    left = {}
    for r in factors.predictions(model, every).collect():
        if (r["userId"], r["productId"]) not in rated and r["prediction"] > 0:
            left.setdefault(r["userId"], []).append((-r["prediction"], r["productId"]))
    got = {}
    for r in factors.user_recs(model, k=4, exclude_rated=ratings).orderBy("userId", "rank").collect():
        got.setdefault(r["userId"], []).append(r["rec_productId"])
    assert got == {u: [p for _, p in sorted(v)[:4]] for u, v in left.items()}


def test_lists_do_not_follow_the_number_of_partitions(ratings):
    """But for rounding: predictions of two runs agree to 1e-4, so lists differ only where two are as close as that."""
    pairs = ratings.select("userId", "productId").distinct()
    made = [{(r.userId, r.productId): r.prediction for r in factors.predictions(
        factors.train_als(ratings.repartition(n), iterations=3), pairs).collect()} for n in (2, 7)]
    assert made[0].keys() == made[1].keys()
    assert max(abs(made[0][p] - made[1][p]) for p in made[0]) < 1e-4


def test_factors_solve_the_normal_equations(ratings, model):
    found = factors.residuals(model, ratings).collect()
    assert len(found) == 40 and max(r.residual for r in found) < 1e-5
    assert sum(r.ratings for r in found) == ratings.count()
    other = model._replace(users=model.users.withColumn("features", F.transform("features", lambda x: x * F.lit(1.01).cast("float"))))
    assert min(r.residual for r in factors.residuals(other, ratings).collect()) > 1e-4


def test_wide_ids_train_and_come_back(ratings, model):
    wide = ratings.select((F.col("userId").cast("long") * 2**40).alias("userId"), (-F.col("productId").cast("long") * 2**33).alias("productId"), "score")
    made = factors.train_als(wide.unionByName(wide.sparkSession.createDataFrame([(None, 5, 1.0), (5, None, 1.0)], wide.schema)))
    assert {r.userId for r in made.users.collect()} == {u * 2**40 for u in range(40)}
    assert max(r.residual for r in factors.residuals(made, wide).collect()) < 1e-5
    lists = factors.user_recs(made, k=3).collect()
    assert {r.rec_productId for r in lists} <= {-p * 2**33 for p in range(30)} and len(lists) == 120


def test_dense_codes_have_no_gaps(spark):
    rng = random.Random(4)
    values = [rng.randrange(-2**62, 2**62) for _ in range(500)]
    book = factors.dense_codes(spark.createDataFrame([(v,) for v in [*values, *values[:50], None]], "v long").repartition(9), "v").collect()
    assert {r.v: r.code for r in book} == {v: i for i, v in enumerate(sorted(values))}


def _plain_top(users, items, k, least, rated):
    out = set()
    for u, x in users.items():
        scored = [(-np.floor(float(np.dot(x, y)) * 1e9 + 0.5) / 1e9, p) for p, y in items.items() if (u, p) not in rated]
        out |= {(u, p, -s, rank) for rank, (s, p) in enumerate(sorted((s, p) for s, p in scored if -s > least)[:k], 1)}
    return out


@pytest.mark.parametrize("block_rows, user_rows", [(5, 7), (16, 1000), (1000, 3)])
@pytest.mark.parametrize("masked", [False, True])
def test_top_products_against_all_products(spark, block_rows, user_rows, masked):
    """With planted ties, whole copies, vectors of no length, and lengths that differ a hundredfold."""
    rng = np.random.default_rng(3)
    items = {p: (rng.integers(-2, 3, 3) * float(rng.choice([0.25, 1, 16]))) for p in range(60)}
    items |= {100 + p: items[7] for p in range(12)} | {200: np.zeros(3)}
    users = {u: rng.integers(-2, 3, 3).astype(float) for u in range(40)} | {90: np.zeros(3)}
    rated = {(u, p) for u in users for p in items if rng.random() < 0.4} if masked else set()
    frame = lambda rows, name: spark.createDataFrame([(i, v.tolist()) for i, v in rows.items()], f"{name} long, features array<double>")
    pairs = spark.createDataFrame([*rated, (90, 5555)], "userId long, productId long") if masked else None
    catalogue = Catalogue(frame(items, "productId"), block_rows)
    for k, least in ((4, 0.0), (80, -3.0)):
        got = catalogue.top(frame(users, "userId"), k, least, pairs, user_rows).collect()
        assert {(r.userId, r.rec_productId, r.score, r.rank) for r in got} == _plain_top(users, items, k, least, rated)


def test_blocks_of_short_vectors_are_skipped(spark):
    rng = np.random.default_rng(5)
    items = spark.createDataFrame([(p, (rng.normal(size=4) / (1 + p)).tolist()) for p in range(300)], "productId long, features array<double>")
    users = spark.createDataFrame([(u, rng.normal(size=4).tolist()) for u in range(50)], "userId long, features array<double>")
    catalogue = Catalogue(items, 20)
    reach = [r.reach for r in catalogue.reach(users, None, 5, 0.0).collect()]
    assert len(catalogue.longest) == 15 and sum(reach) < 0.5 * 15 * 50


def test_no_products_no_lists(spark):
    none = Catalogue(spark.createDataFrame([], "productId long, features array<float>"))
    assert none.top(spark.createDataFrame([(1, [1.0])], "userId long, features array<float>"), 3).collect() == []


def test_product_lists(model):
    whole = factors.product_recs(model)
    cut = factors.product_recs(model, k=3, block_rows=8)
    assert whole.filter("score <= 0.4 OR productId = rec_productId").count() == 0
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, whole.filter("rank <= 3").collect()))
    assert factors.product_similarity(model).count() == whole.count()


def test_grid_search_picks_the_least_error(ratings):
    grid = factors.tune_als(ratings, ranks=(2, 4), regs=(1.0, 0.01), iterations=5)
    cells = grid.collect()
    best = factors.best_parameters(grid).first()
    assert len(cells) == 4 and best["rmse"] == min(c["rmse"] for c in cells)
    assert best["reg"] == 0.01


@pytest.mark.parametrize("block, least, gathered", [(1 << 20, 4, 1 << 18), (200, 1, 40)])
def test_grid_trains_all_cells_in_the_stages_of_one_fit(ratings, monkeypatch, block, least, gathered):
    for name, value in (("BLOCK_RATINGS", block), ("LEAST_BLOCKS", least), ("GATHERED", gathered), ("ROUND", 2)):
        monkeypatch.setattr(alternating, name, value)
    twice = ratings.unionByName(ratings.where("userId % 5 = 0")).unionByName(ratings.where("userId = 3").withColumn("userId", F.lit(99)).limit(1))
    train, held = factors.split(twice)
    cells = [(rank, reg) for rank in (2, 4, 25) for reg in (1.0, 0.05)]
    own = {c: factors.rmse(factors._fit(train.toDF("user", "item", "score", "timestamp"), c[0], 5, c[1], 7).transform(
        held.toDF("user", "item", "score", "timestamp"))).first()["rmse"] for c in cells}
    fits, fit = [], factors._fit
    monkeypatch.setattr(factors, "_fit", lambda train, rank, iterations, *more: fits.append((rank, iterations)) or fit(train, rank, iterations, *more))
    found = {(r["rank"], r["reg"]): r["rmse"] for r in factors.tune_als(twice, (2, 4, 25), (1.0, 0.05), 5).collect()}
    assert found == pytest.approx(own, rel=1e-4)
    assert sorted(fits) == [(2, 0), (4, 0), (25, 0)]


def test_grid_without_known_held_rows_and_with_empty_blocks(spark, ratings):
    train = ratings.where("userId < 3").toDF("user", "item", "score", "timestamp")
    start = {2: factors._fit(train, 2, 0, 0.0, 7).userFactors}
    held = spark.createDataFrame([(1, 999, 3.0), (999, 1, 3.0), (1, 1, None)], "user int, item int, score double")
    assert alternating.grid_errors(train, held, start, [(2, 0.1)], 1) == {(2, 0.1): None}


@pytest.mark.parametrize("gathered", [1, 64, 1 << 18])
def test_least_squares_of_few_and_many_ratings(monkeypatch, gathered):
    monkeypatch.setattr(alternating, "GATHERED", gathered)
    rng = np.random.default_rng(3)
    source, counts = rng.normal(size=(30, 4)).astype(np.float32), np.array([1, 3, 4, 50, 3, 9])
    index, scores = rng.integers(0, 30, counts.sum()).astype(np.int32), rng.random(counts.sum()).astype(np.float32)
    found, at = alternating.solved(source, counts, index, scores, 0.1), 0
    for row, n in zip(found, counts):
        a, r = source[index[at:at + n]].astype(float), scores[at:at + n]
        assert row == pytest.approx(np.linalg.solve(a.T @ a + 0.1 * n * np.eye(4), a.T @ r), rel=1e-5, abs=1e-6)
        at += n


def test_groups_of_models_have_the_largest_rank_at_most():
    cells = [(rank, reg) for rank in (5, 10, 20, 50) for reg in (1.0, 0.1, 0.01)]
    groups = alternating.packed_cells(cells)
    assert sorted(c for g in groups for c in g) == sorted(cells) and len(groups) == 6
    assert all(sum(rank for rank, _ in g) <= 50 for g in groups)


@pytest.mark.parametrize("repeated", [False, True])
def test_neighbouring_blocks_share_a_task(spark, monkeypatch, repeated):
    for name, value in (("MOST_SPANS", 3), ("MOST_PARTS", 2), ("SPAN_ROWS", 50), ("SCORES", 100)):
        monkeypatch.setattr(products, name, value)
    rng = np.random.default_rng(8)
    items = {p: rng.integers(-2, 3, 3).astype(float) * (1 + p % 7) for p in range(120)}
    users = {u: rng.integers(-2, 3, 3).astype(float) for u in range(30)}
    rated = {(u, p) for u in users for p in items if rng.random() < 0.3}
    pairs = spark.createDataFrame([*rated], "userId long, productId long")
    rows = [(i, v.tolist()) for i, v in items.items()]
    catalogue = Catalogue(spark.createDataFrame(rows, "productId long, features array<double>"), 4)
    assert catalogue._merged() == 10
    people = [(u, v.tolist()) for u, v in users.items()]
    got = catalogue.top(spark.createDataFrame(people * (2 if repeated else 1), "userId long, features array<double>"), 5, 0.0, pairs, 1).collect()
    if repeated:  # a user's rows each have a list
        assert {(r.userId, r.rec_productId) for r in got} <= {(u, p) for u, p, _, _ in _plain_top(users, items, 5, 0.0, rated)}
    else:
        assert {(r.userId, r.rec_productId, r.score, r.rank) for r in got} == _plain_top(users, items, 5, 0.0, rated)


def test_ratings_are_joined_once(spark):
    assert "Join" not in executed(catalog._kept_ratings(spark, "/root/testdata/sf0.001"))


def test_grid_in_turns_keeps_the_last_states_alone(ratings, monkeypatch):
    kept, write = [], alternating.RDD.saveAsPickleFile

    def counted(rdd, path, *rest):
        write(rdd, path, *rest)
        home = os.path.dirname(path).removeprefix("file://")
        kept.append(sum(name.startswith("factors-") for name in os.listdir(home)))

    cells = (2, 4, 25), (1.0, 0.05), 3
    plain = {(r["rank"], r["reg"]): r["rmse"] for r in factors.tune_als(ratings, *cells).collect()}
    monkeypatch.setattr(alternating.RDD, "saveAsPickleFile", counted)
    monkeypatch.setattr(alternating, "ALIVE", 1)
    found = {(r["rank"], r["reg"]): r["rmse"] for r in factors.tune_als(ratings, *cells).collect()}
    assert found == {cell: pytest.approx(error, abs=1e-6) for cell, error in plain.items()}
    groups = len(alternating.packed_cells([(rank, reg) for rank in cells[0] for reg in cells[1]]))
    assert len(kept) == groups * 2 * 3 and max(kept) - min(kept) <= 2
    assert alternating.shares(10 ** 12, 6) == (1, 1)


def test_grid_of_small_tables_trains_all_at_once():
    assert alternating.shares(1 << 20, 6) == (6, alternating.ROUND) and alternating.shares(1 << 28, 6) == (2, 1)


def test_training_deletes_what_it_shuffled(spark, ratings):
    def shuffles():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = [files.apply(i).getName() for i in range(files.size())]
        return {name.split("_")[1] for name in names if name.startswith("shuffle_")}

    rows, before = factors.coded(ratings).ratings, shuffles()
    model = factors._fit(rows, 2, 10, 0.1, 7)
    assert len(shuffles() - before) < 20  # two for each iteration, and those of the blocks
    assert model.userFactors.count() == 40
