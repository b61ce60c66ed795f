"""Latent-factor model: training, user lists, product lists, parameter search."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from itertools import product
from typing import NamedTuple

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, functions as F

from cartwise.functions.columns import dot
from cartwise.operators.alternating import grid_errors
from cartwise.operators.products import Catalogue
from cartwise.operators.ranking import global_rank
from cartwise.operators.vectors import BLOCK_ROWS, MIN_SIM, cosine_recs, cosine_similarity
from cartwise.session import checkpoint_dir
from cartwise.sources.scratch import stored

# Model parameters, list length and search grid.
RANK, ITERATIONS, REG = 5, 10, 0.01
USER_LIST = 20
BLOCKS = 10  # user and item blocks; a fixed number, as the factors depend on it
FITS_AT_ONCE = 4
KEPT = 2  # iterations after which the library writes its factors and deletes what it shuffled before
GRID_RANKS, GRID_REGS, GRID_ITERATIONS = (5, 10, 20, 50), (1.0, 0.1, 0.01), 50
MOST_CODE = (1 << 31) - 1  # the widest id the library's model takes


class Factors(NamedTuple):
    """A trained model as two tables: users (userId, features) and products (productId, features)."""

    users: DataFrame
    products: DataFrame


def dense_codes(ids: DataFrame, column: str) -> DataFrame:
    """(column, code): every distinct value with a number from 0 on, without a gap, in the order of the values.

    Made by ranges, so no task sees all values. More than 2^31 of them do not fit a code and fail the job.
    """
    known = ids.select(column).where(F.col(column).isNotNull()).distinct()
    return global_rank(known, [F.asc(column)]).select(column, (F.col("rank") - 1).cast("int").alias("code"))


class Coded(NamedTuple):
    """Ratings (user, item, score) with ids the model takes; the dictionaries are None where ids fit as they are."""

    ratings: DataFrame
    users: DataFrame | None
    items: DataFrame | None


def coded(ratings: DataFrame) -> Coded:
    """Ratings with 32-bit ids; one pass over the ids tells if dictionaries are needed. Rows with a null id drop out."""
    seen = ratings.agg(*[f(c) for c in ("userId", "productId") for f in (F.min, F.max)]).first()
    wide = [any(not -MOST_CODE <= (v or 0) <= MOST_CODE for v in pair) for pair in (seen[:2], seen[2:])]
    rows, books = ratings.where("userId IS NOT NULL AND productId IS NOT NULL"), []
    for column, name, needed in (("userId", "user", wide[0]), ("productId", "item", wide[1])):
        book = stored(dense_codes(rows, column), "codes") if needed else None
        rows = rows.withColumn(name, F.col(column).cast("int")) if book is None else rows.join(
            book.withColumnRenamed("code", name), column)
        books.append(book)
    return Coded(rows, *books)


def _fit(ratings: DataFrame, rank: int, iterations: int, reg: float, seed: int, blocks: int = BLOCKS) -> ALSModel:
    checkpoint_dir(ratings.sparkSession)
    return ALS(
        rank=rank, maxIter=iterations, regParam=reg, seed=seed,
        userCol="user", itemCol="item", ratingCol="score",
        numUserBlocks=blocks, numItemBlocks=blocks,
        coldStartStrategy="drop", checkpointInterval=KEPT,
    ).fit(ratings.select("user", "item", F.col("score").cast("float").alias("score")))


def train_als(
    ratings: DataFrame, rank: int = RANK, iterations: int = ITERATIONS, reg: float = REG,
    seed: int = 7, blocks: int = BLOCKS,
) -> Factors:
    """Explicit-feedback ALS over ids of 64 bits.

    Ids beyond the 32 bits of the library's model go through a dictionary of dense codes and come back. ``blocks``,
    the number of user and of item blocks, does not follow the cluster. The library adds up ratings in
    the order they arrive, in single precision, so a seed gives factors alike but for rounding: predictions of two runs
    differ by some 1e-5, and lists only where two products are as close as that. Users or products without a rating
    have no factors. The two tables are written to the shared folder.
    """
    rows = coded(ratings)
    model = _fit(rows.ratings, rank, iterations, reg, seed, blocks)

    def named(factors: DataFrame, book: DataFrame | None, column: str) -> DataFrame:
        if book is None:
            return stored(factors.select(F.col("id").cast("bigint").alias(column), "features"), "factors")
        return stored(factors.join(book, factors.id == book.code).select(F.col(column).cast("bigint"), "features"), "factors")

    return Factors(named(model.userFactors, rows.users, "userId"), named(model.itemFactors, rows.items, "productId"))


def predictions(model: Factors, pairs: DataFrame) -> DataFrame:
    """``pairs`` (userId, productId, ...) with ``prediction``; pairs the model does not know drop out."""
    mine = model.users.select("userId", F.col("features").alias("_user"))
    theirs = model.products.select("productId", F.col("features").alias("_product"))
    return pairs.join(mine, "userId").join(theirs, "productId").withColumn(
        "prediction", dot(F.col("_user"), F.col("_product"))).drop("_user", "_product")


def user_recs(
    model: Factors, k: int = USER_LIST, min_pred: float = 0.0, exclude_rated: DataFrame | None = None
) -> DataFrame:
    """(userId, rec_productId, score, rank): the k best predictions above ``min_pred``, ties by productId.

    Predictions are compared on the 1e-9 grid, in the list as at its end. ``exclude_rated`` holds ratings
    (userId, productId) that are not offered.
    """
    return Catalogue(model.products).top(model.users, k, min_pred, exclude_rated)


def residuals(model: Factors, ratings: DataFrame, reg: float = REG) -> DataFrame:
    """(userId, ratings, residual): how far each user's factors are from the least squares solution for the products'.

    The last half-step of the training solves, for every user with n ratings, (A'A + reg n I) x = A'r over the factors A of
    the products rated. ``residual`` is the largest entry of the difference of both sides, as a share of
    the sum of the sizes of its terms; rounding in single precision leaves some 1e-6.
    """
    width = len(model.users.first()["features"])
    rows = ratings.select("userId", "productId", "score").join(
        model.products.select("productId", F.col("features").alias("q")), "productId").join(
        model.users.select("userId", F.col("features").alias("x")), "userId")

    def q(j: int) -> Column:
        return F.col("q")[j].cast("double")

    error, size = dot(F.col("q"), F.col("x")) - F.col("score"), F.abs(dot(F.col("q"), F.col("x"))) + F.abs("score")
    summed = rows.withColumn("error", error).withColumn("size", size).groupBy("userId").agg(
        F.count("*").alias("ratings"), F.first("x").alias("x"),
        *[F.sum(q(j) * F.col("error")).alias(f"g{j}") for j in range(width)],
        *[F.sum(F.abs(q(j)) * F.col("size")).alias(f"s{j}") for j in range(width)],
    )
    pull = [reg * F.col("ratings") * F.col("x")[j].cast("double") for j in range(width)]
    gaps = [F.abs(F.col(f"g{j}") + pull[j]) / F.nullif(F.col(f"s{j}") + F.abs(pull[j]), F.lit(0.0)) for j in range(width)]
    return summed.select("userId", "ratings", F.array_max(F.array(*[F.coalesce(g, F.lit(0.0)) for g in gaps])).alias("residual"))


def product_similarity(
    model: Factors, min_sim: float = MIN_SIM, k: int | None = None, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(p1, p2, score): cosine of the item factors above ``min_sim``; whole without ``k``."""
    return cosine_similarity(model.products, "productId", "features", min_sim, k, block_rows)


def product_recs(
    model: Factors, min_sim: float = MIN_SIM, k: int | None = None, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(productId, rec_productId, score, rank): cosine of the item factors."""
    return cosine_recs(model.products, "productId", "features", min_sim, k, block_rows)


def rmse(predictions: DataFrame, actual: str = "score", predicted: str = "prediction", by: list[str] | None = None) -> DataFrame:
    """Root mean squared error, of each group if columns are given to group ``by``."""
    error = F.col(actual) - F.col(predicted)
    return predictions.groupBy(*(by or [])).agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def tune_als(
    ratings: DataFrame, ranks=GRID_RANKS, regs=GRID_REGS, iterations: int = GRID_ITERATIONS, seed: int = 7,
) -> DataFrame:
    """(rank, iterations, reg, rmse) of every grid cell on a held-out fifth.

    The library draws the factors each rank starts from, as in a fit of its own; all cells are then trained side by side,
    a half-step of all of them in one stage, and agree with fits of their own but for rounding. Only two sums of a cell
    reach the driver. Split by a hash of the row, not of its position, so the held-out rows do not depend on partitioning.
    """
    spark = ratings.sparkSession
    train, held = (stored(part, "split") for part in split(coded(ratings).ratings, seed))
    with ThreadPoolExecutor(FITS_AT_ONCE) as pool:
        drawn = dict(zip(ranks, pool.map(lambda rank: _fit(train, rank, 0, 0.0, seed), ranks)))
    cells = list(product(ranks, regs))
    if iterations:
        starts = {rank: model.userFactors for rank, model in drawn.items()}
        errors = grid_errors(train, held, starts, list(dict.fromkeys(cells)), iterations)
    else:
        errors = {cell: rmse(drawn[cell[0]].transform(held)).first()["rmse"] for cell in cells}
    rows = [(rank, iterations, float(reg), errors[rank, reg]) for rank, reg in cells]
    return spark.createDataFrame(rows, "rank int, iterations int, reg double, rmse double")


def split(ratings: DataFrame, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """Four fifths to train on and a fifth to hold out, by a hash of the row."""
    slot = F.pmod(F.xxhash64("userId", "productId", "score", "timestamp", F.lit(seed)), F.lit(10))
    return ratings.filter(slot < 8), ratings.filter(slot >= 8)


def best_parameters(grid: DataFrame) -> DataFrame:
    """The grid cell with the least error."""
    best = F.min_by(F.struct("rank", "iterations", "reg", "rmse"), F.col("rmse")).alias("_best")
    return grid.agg(best).select("_best.*")
