"""The same queries as plain SQL over the raw tables, for an independent engine."""

from __future__ import annotations

TOP = 20

RATINGS = """ratings AS (
  SELECT CAST(o_custkey AS BIGINT) AS "userId", CAST(l_partkey AS BIGINT) AS "productId",
         CAST(1 + CAST(l_quantity AS INTEGER) % 5 AS DOUBLE) AS score,
         CAST(epoch(o_orderdate) AS BIGINT) AS "timestamp"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

EVENTS = """ev AS (
  SELECT CAST(user_id AS BIGINT) AS "userId",
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS "productId",
         CAST(1 + CAST(floor("value") AS INTEGER) % 5 AS DOUBLE) AS score,
         CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp"
  FROM events)"""

PRODUCTS = """products AS (
  SELECT CAST(p_partkey AS BIGINT) AS "productId", p_name AS name, p_type AS categories,
         replace(p_name || ' ' || p_brand || ' ' || p_type, ' ', '|') AS tags
  FROM part)"""

AVERAGES = 'averages AS (SELECT "productId", avg(score) AS "avg" FROM ratings GROUP BY 1)'

TFIDF = """words AS (
  SELECT "productId", unnest(string_split(lower(replace(tags, '|', ' ')), ' ')) AS term FROM products),
tf AS (SELECT "productId", term, count(*) AS tf FROM words GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
weights AS (
  SELECT "productId", term, tf, df, tf * ln(((SELECT count(*) FROM products) + 1) / (df + 1)) AS weight
  FROM tf JOIN df USING (term)),
norms AS (SELECT "productId", sqrt(sum(weight * weight)) AS norm FROM weights GROUP BY 1)"""

# The bucket of a word: murmur3 of its bytes, 32 bits, seed 42, whole words little-endian and the bytes left over one
# by one, as the built-in hash does; then modulo the bucket count. Words here are ASCII.
BUCKET = """terms AS (
  SELECT DISTINCT unnest(string_split(lower(replace(tags, '|', ' ')), ' ')) AS word FROM products),
bytes AS (SELECT word, length(word) AS n, list_transform(string_split(word, ''), lambda c: ascii(c)::UBIGINT) AS b FROM terms),
blocks AS (
  SELECT word, n, list_concat(
    list_transform(range(0, n // 4), lambda i: b[4 * i + 1] | (b[4 * i + 2] << 8) | (b[4 * i + 3] << 16) | (b[4 * i + 4] << 24)),
    b[4 * (n // 4) + 1:]) AS k FROM bytes),
mixed AS (
  SELECT word, n, list_transform(list_transform(list_transform(k, lambda x: (x * 3432918353::UBIGINT) & 4294967295),
    lambda x: ((x << 15) | (x >> 17)) & 4294967295), lambda x: (x * 461845907::UBIGINT) & 4294967295) AS k FROM blocks),
folded AS (
  SELECT word, xor(list_reduce(list_prepend(42::UBIGINT, k), lambda h, x:
    ((((xor(h, x) << 13) | (xor(h, x) >> 19)) & 4294967295) * 5 + 3864292196::UBIGINT) & 4294967295), n::UBIGINT) AS h FROM mixed),
f1 AS (SELECT word, (xor(h, h >> 16) * 2246822507::UBIGINT) & 4294967295 AS h FROM folded),
f2 AS (SELECT word, (xor(h, h >> 13) * 3266489909::UBIGINT) & 4294967295 AS h FROM f1),
f3 AS (SELECT word, xor(h, h >> 16)::BIGINT AS h FROM f2),
buckets AS (
  SELECT word, CAST((((CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % 800) + 800) % 800 AS INTEGER) AS term FROM f3)"""

HASHED = BUCKET + ",\n" + TFIDF.replace("AS term FROM products)", "AS word FROM products)").replace(
    "words AS (", "all_words AS (").replace(
    "tf AS (SELECT", "words AS (SELECT \"productId\", term FROM all_words JOIN buckets USING (word)),\ntf AS (SELECT", 1)

CONTENT = TFIDF + """,
dots AS (
  SELECT a."productId" AS p1, b."productId" AS p2, sum(a.weight * b.weight) AS d
  FROM weights a JOIN weights b ON a.term = b.term AND a."productId" <> b."productId" GROUP BY 1, 2),
sim AS (
  SELECT p1, p2, score FROM (
    SELECT p1, p2, floor(d / (x.norm * y.norm) * 1e9 + 0.5) / 1e9 AS score
    FROM dots JOIN norms x ON x."productId" = p1 JOIN norms y ON y."productId" = p2
    WHERE x.norm > 0 AND y.norm > 0) s
  WHERE score > 0.4)"""


def _item_cf(distinct: bool) -> str:
    source = 'SELECT DISTINCT "userId", "productId" FROM ratings' if distinct else "SELECT * FROM ratings"
    return f"""rated AS ({source}),
counts AS (SELECT "productId", count(*) AS n FROM rated GROUP BY 1),
co AS (
  SELECT a."productId" AS p1, b."productId" AS p2, count(*) AS cocount
  FROM rated a JOIN rated b ON a."userId" = b."userId" AND a."productId" <> b."productId" GROUP BY 1, 2),
pairs AS (
  SELECT p1, p2, cocount, x.n AS count1, y.n AS count2, cocount / sqrt(CAST(x.n AS DOUBLE) * y.n) AS score
  FROM co JOIN counts x ON x."productId" = p1 JOIN counts y ON y."productId" = p2),
itemcf AS (SELECT * FROM (
  SELECT p1 AS "productId", p2 AS "rec_productId", score,
         CAST(row_number() OVER (PARTITION BY p1 ORDER BY score DESC, p2) AS INTEGER) AS "rank"
  FROM pairs) r WHERE "rank" <= 10)"""


CONTENT_RANKED = """ranked AS (
  SELECT p1 AS "productId", p2 AS "rec_productId", score,
         CAST(row_number() OVER (PARTITION BY p1 ORDER BY score DESC, p2) AS INTEGER) AS "rank" FROM sim)"""

DENSE = """WITH v AS (SELECT CAST(vec_id AS BIGINT) AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT id, e, sqrt(list_dot_product(e, e)) AS norm FROM v WHERE list_dot_product(e, e) > 0),
sim AS (SELECT * FROM (
  SELECT a.id AS p1, b.id AS p2, floor(list_dot_product(a.e, b.e) / (a.norm * b.norm) * 1e9 + 0.5) / 1e9 AS score
  FROM u a JOIN u b ON a.id <> b.id) s WHERE score > 0.4),
""" + CONTENT_RANKED + "\n"

LATEST = """latest AS (SELECT "userId", "productId", score, "timestamp" FROM (
  SELECT *, row_number() OVER (PARTITION BY "userId" ORDER BY "timestamp" DESC, "productId" DESC, score DESC) AS rn
  FROM ev) x WHERE rn = 1)"""

LATEST_RATED = LATEST.replace("latest AS", "last_rated AS").replace("FROM ev", "FROM ratings")

CANDIDATES = """cands AS (SELECT * FROM (
  SELECT l."userId", s.p2 AS candidate, s.score,
         CAST(row_number() OVER (PARTITION BY l."userId" ORDER BY s.score DESC, s.p2) AS INTEGER) AS "rank"
  FROM latest l JOIN sim s ON s.p1 = l."productId"
  WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r."userId" = l."userId" AND r."productId" = s.p2)
    AND NOT EXISTS (SELECT 1 FROM ev e WHERE e."userId" = l."userId" AND e."productId" = s.p2)) c
  WHERE "rank" <= 20)"""


def _recents(source: str, n: int) -> str:
    return f"""recents AS (SELECT * FROM (
  SELECT "userId", "productId", score, "timestamp", CAST(row_number() OVER (
    PARTITION BY "userId" ORDER BY "timestamp" DESC, "productId", score) AS INTEGER) AS "rank"
  FROM {source}) q WHERE "rank" <= {n})"""


SCORES = """scored AS (
  SELECT c."userId", c.candidate AS "productId",
         floor((CAST(sum(CAST(s.score AS DECIMAL(11,9)) * CAST(r.score AS DECIMAL(18,9))) AS DOUBLE) / count(*)
                + (log10(greatest(1, count(*) FILTER (r.score > 3)))
                   - log10(greatest(1, count(*) FILTER (r.score <= 3))))) * 1e9 + 0.5) / 1e9 AS score
  FROM cands c JOIN recents r ON r."userId" = c."userId"
  JOIN sim s ON s.p1 = c.candidate AND s.p2 = r."productId" GROUP BY 1, 2),
live AS (
  SELECT "userId", "productId", score, CAST(row_number() OVER (
    PARTITION BY "userId" ORDER BY score DESC, "productId") AS INTEGER) AS "rank" FROM scored)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _hydrate(key: str, source: str, rec: str = '"rec_productId"') -> str:
    return (
        f'SELECT t."{key}", t.{rec} AS "rec_productId", t.score, t."rank", p.name, p.categories, p.tags, '
        f'coalesce(a."avg", 0.0) AS "avg" FROM {source} t JOIN products p ON p."productId" = t.{rec} '
        f'LEFT JOIN averages a ON a."productId" = t.{rec}'
    )


def _top_list(columns: str, source: str, order: str) -> str:
    return (
        f"first AS (SELECT {columns}, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS \"rank\" FROM {source} "
        f"ORDER BY {order} LIMIT {TOP})\n"
        f'SELECT first.*, p.name, p.categories, p.tags, coalesce(a."avg", 0.0) AS "avg" FROM first '
        f'JOIN products p ON p."productId" = first."productId" '
        f'LEFT JOIN averages a ON a."productId" = first."productId"'
    )


CELLS = """cells AS (
  SELECT CAST(r AS INTEGER) AS "rank", 50 AS iterations, CAST(g AS DOUBLE) AS reg,
         floor(sqrt(avg((score - mean / (1 + g / r)) * (score - mean / (1 + g / r)))) * 1e9 + 0.5) / 1e9 AS rmse
  FROM (SELECT score, avg(score) OVER (PARTITION BY "productId") AS mean FROM ratings) m,
       (VALUES (5::DOUBLE), (10::DOUBLE)) AS a(r), (VALUES (1.0::DOUBLE), (0.1::DOUBLE), (0.01::DOUBLE)) AS b(g)
  GROUP BY r, g)"""

VECTOR_LISTS = f"""v AS (SELECT CAST(vec_id AS BIGINT) AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
lists AS (SELECT * FROM (
  SELECT "userId", "rec_productId", score, CAST(row_number() OVER (
    PARTITION BY "userId" ORDER BY score DESC, "rec_productId") AS INTEGER) AS "rank" FROM (
      SELECT a.id AS "userId", b.id AS "rec_productId", floor(list_dot_product(a.e, b.e) * 1e9 + 0.5) / 1e9 AS score
      FROM v a JOIN v b ON b.id NOT IN (a.id, a.id + 1)) s WHERE score > 0) r WHERE "rank" <= {TOP})
"""

MONTH = "CAST(strftime(make_timestamp(\"timestamp\" * 1000000), '%Y%m') AS INTEGER)"
COUNTS = 'counts AS (SELECT "productId", count(*) AS "count" FROM ratings GROUP BY 1)'
MONTHS = (
    f'months AS (SELECT "productId", count(*) AS "count", yearmonth FROM '
    f'(SELECT "productId", {MONTH} AS yearmonth FROM ratings) m GROUP BY "productId", yearmonth)'
)
CARDS = (
    'SELECT p.*, coalesce(a."avg", 0.0) AS "avg" FROM products p '
    'LEFT JOIN averages a ON a."productId" = p."productId"'
)

ORACLES: dict[str, str] = {
    "rate_more_products": _with(RATINGS, COUNTS) + "SELECT * FROM counts",
    "rate_more_recently": _with(RATINGS, MONTHS) + "SELECT * FROM months",
    "sql_monthly": _with(RATINGS, MONTHS) + "SELECT * FROM months",
    "average_products": _with(RATINGS, AVERAGES) + "SELECT * FROM averages",
    "monthly_rollup": _with(RATINGS)
    + f'SELECT {MONTH} AS yearmonth, "productId", count(*) AS "count", sum(score) AS score_sum '
      "FROM ratings GROUP BY 1, 2",
    "averages_from_rollup": _with(RATINGS)
    + 'SELECT "productId", count(*) AS "count", avg(score) AS "avg" FROM ratings GROUP BY 1',
    "distinct_ids": _with(RATINGS)
    + 'SELECT DISTINCT \'user\' AS kind, "userId" AS id FROM ratings '
      'UNION ALL SELECT DISTINCT \'product\', "productId" FROM ratings',
    "most_rated": _with(RATINGS, PRODUCTS, AVERAGES, COUNTS)
    .rstrip() + ",\n" + _top_list('"productId", "count"', "counts", '"count" DESC, "productId"'),
    "hot_products": _with(RATINGS, PRODUCTS, AVERAGES, MONTHS)
    .rstrip() + ",\n"
    + _top_list('"productId", "count", yearmonth', "months", 'yearmonth DESC, "count" DESC, "productId"'),
    "best_rated": _with(RATINGS, PRODUCTS, AVERAGES)
    .rstrip() + ",\n" + _top_list('"productId"', "averages", '"avg" DESC, "productId"'),
    "product_cards": _with(RATINGS, PRODUCTS, AVERAGES) + CARDS,
    "product_info": _with(RATINGS, PRODUCTS, AVERAGES, EVENTS)
    + CARDS + ' WHERE p."productId" IN (SELECT "productId" FROM ev)',
    "search_products": _with(RATINGS, PRODUCTS, AVERAGES)
    + CARDS + " WHERE regexp_matches(p.name, 'b[lo]+.* (ring|bolt)')",
    "cooccurrence": _with(RATINGS, _item_cf(False)) + "SELECT * FROM pairs WHERE p1 < p2",
    "item_cf": _with(RATINGS, _item_cf(False)) + "SELECT * FROM itemcf",
    "item_cf_distinct_users": _with(RATINGS, _item_cf(True)) + "SELECT * FROM itemcf",
    "item_cf_heavy_blocks": _with(RATINGS, _item_cf(False)) + "SELECT * FROM itemcf",
    "sql_item_similarity": _with(RATINGS, _item_cf(False))
    + 'SELECT p1 AS "productId", count(*) AS partners, CAST(sum(cocount) AS BIGINT) AS co_ratings, '
      "max(score) AS best FROM pairs GROUP BY 1",
    "similar_itemcf": _with(RATINGS, PRODUCTS, AVERAGES, _item_cf(False)) + _hydrate("productId", "itemcf"),
    "tfidf_exact": _with(PRODUCTS, TFIDF)
    + 'SELECT "productId", term, tf, df, floor(weight * 1e9 + 0.5) / 1e9 AS weight FROM weights',
    "tfidf_hashed": _with(PRODUCTS, HASHED)
    + 'SELECT "productId", term, tf, df, floor(weight * 1e9 + 0.5) / 1e9 AS weight FROM weights',
    "content_recs_hashed": _with(PRODUCTS, CONTENT.replace(TFIDF, HASHED), CONTENT_RANKED) + "SELECT * FROM ranked",
    "content_recs": _with(PRODUCTS, CONTENT, CONTENT_RANKED) + "SELECT * FROM ranked",
    "content_recs_top": _with(PRODUCTS, CONTENT, CONTENT_RANKED) + f'SELECT * FROM ranked WHERE "rank" <= {TOP}',
    "similar_content": _with(RATINGS, PRODUCTS, AVERAGES, CONTENT, CONTENT_RANKED)
    + _hydrate("productId", "ranked"),
    "similar_asked": _with(RATINGS, PRODUCTS, AVERAGES, EVENTS, CONTENT, CONTENT_RANKED)
    + _hydrate("productId", '(SELECT * FROM ranked WHERE "rank" <= 5 AND "productId" IN (SELECT "productId" FROM ev))'),
    "similarity_maps": _with(RATINGS, _item_cf(False)) + 'SELECT "productId" AS p1, "rec_productId" AS p2, score FROM itemcf',
    "als_list_shape": _with(RATINGS)
    + f'SELECT DISTINCT "userId", least({TOP}, (SELECT count(DISTINCT "productId") FROM ratings)) AS length, true AS good FROM ratings',
    "als_unrated_shape": _with(RATINGS)
    + f'SELECT "userId", least({TOP}, (SELECT count(DISTINCT "productId") FROM ratings) - count(DISTINCT "productId")) AS length, '
      "true AS good FROM ratings GROUP BY 1",
    "als_optimality": _with(RATINGS) + 'SELECT "userId", count(*) AS ratings, true AS good FROM ratings GROUP BY 1',
    "als_wide_ids": _with(RATINGS)
    + 'SELECT "userId" * 4294967311 AS "userId", count(*) AS ratings, true AS good FROM ratings GROUP BY 1',
    "als_rmse_joined": """SELECT CAST(r AS INTEGER) AS "rank", 5 AS iterations, 0.1::DOUBLE AS reg,
  (SELECT count(*) FROM lineitem) AS ratings, true AS agree FROM (VALUES (3), (6)) AS c(r)""",
    "factor_top": "WITH " + VECTOR_LISTS + "SELECT * FROM lists",
    "offline_read": _with(RATINGS, PRODUCTS, AVERAGES, VECTOR_LISTS) + _hydrate("userId", "lists"),
    "saved_table": _with(RATINGS) + "SELECT * FROM ratings",
    "rate_more_ranked": _with(RATINGS, COUNTS)
    + 'SELECT *, row_number() OVER (ORDER BY "count" DESC, "productId") AS "rank" FROM counts',
    "rate_more_recently_ranked": _with(RATINGS, MONTHS)
    + 'SELECT *, row_number() OVER (ORDER BY yearmonth DESC, "count" DESC, "productId") AS "rank" FROM months',
    "average_ranked": _with(RATINGS, AVERAGES)
    + 'SELECT *, row_number() OVER (ORDER BY "avg" DESC, "productId") AS "rank" FROM averages',
    "rating_scan": _with(RATINGS) + 'SELECT * FROM ratings WHERE "productId" % 7 <> 0 AND "productId" % 11 <> 0',
    "rating_rejects": _with(RATINGS) + """SELECT concat_ws(',', "userId", "productId",
    CASE WHEN "productId" % 7 = 0 THEN 'high' WHEN "userId" % 3 = 0 THEN '"' || score || '"' ELSE score::VARCHAR END,
    CASE WHEN "productId" % 11 <> 0 THEN CASE WHEN "userId" % 5 = 0 THEN "timestamp" * 1000 + 123 ELSE "timestamp" END END) AS "value"
  FROM ratings WHERE "productId" % 7 = 0 OR "productId" % 11 = 0""",
    "product_scan": _with(PRODUCTS) + """SELECT "productId", '5" ' || name AS name, 'img' AS "imageUrl", categories, tags
  FROM products WHERE "productId" % 7 <> 0 AND "productId" % 11 <> 0""",
    "product_rejects": _with(PRODUCTS) + """SELECT concat_ws('^', CASE WHEN "productId" % 7 = 0 THEN 'x' || "productId" ELSE "productId"::VARCHAR END,
    ' 5" ' || name, '1,2', 'B9', CASE WHEN "productId" % 11 <> 0 THEN concat_ws('^', 'img', categories, tags,
      CASE WHEN "productId" % 5 = 0 THEN 'more' END) END) AS "value"
  FROM products WHERE "productId" % 7 = 0 OR "productId" % 11 = 0""",
    "rmse_by_cell": _with(RATINGS, CELLS) + "SELECT * FROM cells",
    "least_cell": _with(RATINGS, CELLS) + "SELECT * FROM cells ORDER BY rmse LIMIT 1",
    "fine_means": """SELECT l_suppkey, floor(CAST(sum(CAST(floor(l_discount * 1e9 + 0.5) / 1e9 AS DECIMAL(11,9))
    * CAST(floor(l_extendedprice + 0.5) / 1000 AS DECIMAL(18,9))) AS DOUBLE) / count(*) * 1e9 + 0.5) / 1e9 AS mean
FROM lineitem GROUP BY 1""",
    "table_scan": "SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_brand FROM part",
    "malformed_lines": _with(EVENTS) + 'SELECT count(*) AS malformed FROM ev WHERE "userId" % 3 = 0',
    "dense_cosine_recs": DENSE + "SELECT * FROM ranked",
    "dense_cosine_top": DENSE + 'SELECT * FROM ranked WHERE "rank" <= 5',
    "upsert_ratings": _with(RATINGS, EVENTS)
    + """SELECT * FROM ratings r WHERE NOT EXISTS (
  SELECT 1 FROM ev e WHERE e."userId" = r."userId" AND e."productId" = r."productId")
UNION ALL SELECT "userId", "productId", score, "timestamp" FROM (
  SELECT *, row_number() OVER (PARTITION BY "userId", "productId" ORDER BY "timestamp" DESC, score DESC) AS rn
  FROM ev) x WHERE rn = 1""",
    "recent_ratings": _with(RATINGS, _recents("ratings", 20)) + "SELECT * FROM recents",
    "recent_queue": _with(EVENTS, _recents("ev", 40)) + "SELECT * FROM recents",
    "latest_event": _with(EVENTS, LATEST) + "SELECT * FROM latest",
    "replaced_lists": _with(RATINGS, EVENTS, LATEST, LATEST_RATED)
    + 'SELECT * FROM latest UNION ALL SELECT * FROM last_rated WHERE "userId" NOT IN (SELECT "userId" FROM latest)',
    "stream_candidates": _with(RATINGS, EVENTS, PRODUCTS, CONTENT, LATEST, CANDIDATES) + "SELECT * FROM cands",
    "stream_scores": _with(RATINGS, EVENTS, PRODUCTS, CONTENT, LATEST, CANDIDATES, _recents("ev", 20), SCORES)
    + "SELECT * FROM live",
    "live_recs": _with(RATINGS, EVENTS, PRODUCTS, CONTENT, LATEST, CANDIDATES, _recents("ev", 20), SCORES) + "SELECT * FROM live",
    "stream_recs": _with(
        RATINGS, EVENTS, PRODUCTS, AVERAGES, CONTENT, LATEST, CANDIDATES, _recents("ev", 20), SCORES
    ) + _hydrate("userId", "live", '"productId"'),
    "extract_events": _with(EVENTS)
    + 'SELECT concat_ws(\'|\', "userId", "productId", score, "timestamp") AS "value" FROM ev',
    "parse_events": _with(EVENTS) + "SELECT * FROM ev",
    "event_text": _with(EVENTS)
    + f'SELECT "userId", "productId", "timestamp", score / 2 AS half, {MONTH} AS yearmonth, '
      '"timestamp" AS seconds, \'PRODUCT_RATING_PREFIX:\' || '
      'concat_ws(\'|\', "userId", "productId", score, "timestamp") AS message FROM ev',
}
