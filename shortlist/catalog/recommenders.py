"""Recommenders."""

from __future__ import annotations

from pyspark.sql import functions as F

from shortlist.catalog.aggregates import VEC_DIM
from shortlist.catalog.base import K, SEED, VIEWS, query, topk_view, with_views
from shortlist.catalog.feature_tables import vector_pairs
from shortlist.catalog.tables_and_joins import N_CANDIDATES
from shortlist.functions.randomness import uniform_sql
from shortlist.operators import features as feat
from shortlist.operators import popularity as pop
from shortlist.operators import recommend as rec
from shortlist.session import durable
from shortlist.sources import tables as tb
from shortlist.streaming.item_stats import item_stats_stream, read_log, streaming_scores


def inputs(spark, d):
    return tb.interactions(spark, d), tb.users(spark, d), tb.items(spark, d)


@query("rec_ucb", with_views(["recs"], "SELECT * FROM recs"))
def rec_ucb(spark, d):
    return rec.ucb(*inputs(spark, d), K)


@query("rec_popularity", with_views(["users", "pop_table", "seen"], topk_view("SELECT user_idx, item_idx, relevance FROM users CROSS JOIN pop_table")))
def rec_popularity(spark, d):
    return rec.popularity(*inputs(spark, d), K)


@query(
    "rec_ucb_raw",
    with_views(
        ["history", "ucb_table", "items"],
        f"""SELECT user_idx, item_idx, relevance, rank FROM history
            JOIN (SELECT *, row_number() OVER (ORDER BY relevance DESC, item_idx DESC) AS rank FROM ucb_table) ON rank <= history.items + {K}""",
    ),
)
def rec_ucb_raw(spark, d):
    return rec.ucb_raw(*inputs(spark, d), K)


@query(
    "score_pairs_ucb",
    with_views(["users", "items", "ucb_table"], f"""SELECT user_idx, item_idx, relevance FROM users
        CROSS JOIN (SELECT item_idx FROM items ORDER BY {uniform_sql(SEED, 'item_idx')}, item_idx LIMIT {N_CANDIDATES}) JOIN ucb_table USING (item_idx)"""),
)
def score_pairs_ucb(spark, d):
    log, users, items = inputs(spark, d)
    pairs = rec.random_candidates(users, items, N_CANDIDATES, SEED)
    return rec.scored_pairs(pairs, log).withColumn("relevance", F.round("relevance", 9))


@query(
    "rec_ucb_price",
    with_views(
        ["users", "ucb_table", "items", "seen"],
        topk_view(
            """SELECT user_idx, item_idx, relevance FROM users CROSS JOIN (
                 SELECT item_idx, round(relevance_raw + 0.3::DOUBLE * (price - lo) / (hi - lo), 9) AS relevance
                 FROM (SELECT item_idx, coalesce(ucb.relevance, 1.0 + sqrt(ln(2.0 * (SELECT count(*) FROM log)))) AS relevance_raw, price
                       FROM items LEFT JOIN ucb USING (item_idx)), (SELECT min(price) AS lo, max(price) AS hi FROM items))"""
        ),
    ),
)
def rec_ucb_price(spark, d):
    return rec.ucb_price(*inputs(spark, d), K)


@query(
    "expected_revenue_topk",
    with_views(
        ["users", "pop_table", "items", "seen"],
        topk_view(
            """SELECT user_idx, item_idx, relevance FROM users CROSS JOIN (
                 SELECT item_idx, round(coalesce((pos + 1.0) / (total + 2.0), 0.5) * price, 9) AS relevance
                 FROM items LEFT JOIN counts USING (item_idx))"""
        ),
    ),
)
def expected_revenue_topk(spark, d):
    log, users, items = inputs(spark, d)
    return rec.expected_revenue(pop.popularity_table(log, items), items, users, log, K)


@query(
    "rec_sequence_price",
    with_views(
        ["users", "items", "seen", "ucb"],
        topk_view(
            """SELECT user_idx, item_idx, round(coalesce(ucb.relevance, 1.0 + sqrt(ln(2.0 * (SELECT count(*) FROM log)))) * price, 9) AS relevance
               FROM users CROSS JOIN items LEFT JOIN ucb USING (item_idx)"""
        ),
    ),
)
def rec_sequence_price(spark, d):
    """The tail of the sequence model: a model's scores times price, over all unseen items, top-k."""
    log, users, items = inputs(spark, d)
    return rec.expected_revenue(pop.ucb_table(log, items), items, users, log, K)


# --- random draws: the stream of draws is written out to a fixed length in the oracle ---------


def _draws(seed, users: str, factor: int, weight: str) -> str:
    """Draw numbers 1..factor of each user, resolved to items and accepted by weight."""
    return f"""SELECT user_idx, item_idx, min(draw) AS draw FROM (
        SELECT user_idx, draw, floor({uniform_sql(f'{seed}/item', 'user_idx', 'draw')} * (SELECT count(*) FROM items))::BIGINT AS number,
               {uniform_sql(f'{seed}/keep', 'user_idx', 'draw')} AS keep
        FROM {users}, range(1, {factor}) t(draw))
      JOIN (SELECT item_idx, row_number() OVER (ORDER BY item_idx) - 1 AS number, {weight}) USING (number)
      WHERE keep < w GROUP BY 1, 2"""


_FREE = "SELECT user_idx, (SELECT count(*) FROM items) - items AS free FROM history"
_RANDOM = f"""WITH d AS ({_draws(SEED, 'users', 200, '1.0 AS w FROM items')}),
  p AS (SELECT user_idx, item_idx, row_number() OVER (PARTITION BY user_idx ORDER BY draw) AS rank FROM d ANTI JOIN seen USING (user_idx, item_idx)),
  s AS (SELECT user_idx, rank, round(exp(sum(ln(1.0 - {uniform_sql(f'{SEED}/score', 'user_idx', 'rank')}) / (free - rank + 1))
          OVER (PARTITION BY user_idx ORDER BY rank)), 9) AS relevance FROM ({_FREE}), range(1, {K + 1}) t(rank))
SELECT user_idx, item_idx, relevance, rank::INTEGER AS rank FROM p JOIN s USING (user_idx, rank)"""


@query("rec_random", with_views(["users", "items", "seen", "history"], _RANDOM).replace("\nWITH d AS", ",\nd AS"))
def rec_random(spark, d):
    return rec.random_topk(*inputs(spark, d), K, SEED)


_SAMPLED = f"""WITH raw AS (SELECT item_idx, coalesce(ucb.relevance, 1.0 + sqrt(ln(2.0 * (SELECT count(*) FROM log)))) AS score
         FROM items LEFT JOIN ucb USING (item_idx)),
  d AS ({_draws(SEED, 'users', 1200, 'score / (SELECT max(score) FROM raw) AS w FROM raw')}),
  p AS (SELECT user_idx, item_idx, row_number() OVER (PARTITION BY user_idx ORDER BY draw) AS rank FROM d)
SELECT user_idx, item_idx, round(score / (SELECT sum(score) FROM raw), 12) AS relevance, rank::INTEGER AS rank
FROM p JOIN history USING (user_idx) JOIN raw USING (item_idx)
WHERE rank <= least(history.items + {K}, (SELECT count(*) FROM items))"""


@query("rec_ucb_sampled", with_views(["users", "items", "history", "ucb"], _SAMPLED).replace("\nWITH raw AS", ",\nraw AS"))
def rec_ucb_sampled(spark, d):
    return rec.ucb_sampled(*inputs(spark, d), K, SEED)


# --- personal scores ------------------------------------------------------------------------

_COSINE = """SELECT user_idx, item_idx, round(CASE WHEN weight > 0 THEN coalesce(list_cosine_similarity(profiles.vec, vec.vec), 0.0) ELSE 0.0 END, 9) AS relevance
             FROM profiles CROSS JOIN vec"""
# similarities rounded to nine digits before they are compared with the threshold
VIEWS["content_known"] = (("profiles", "vec", "seen"), topk_view(f"SELECT * FROM ({_COSINE}) WHERE relevance >= 0"))


# users without a profile: the stream of random draws over the items that have a vector
_COLD = f"""SELECT user_idx, item_idx, relevance, rank::INTEGER AS rank FROM (
    SELECT user_idx, item_idx, row_number() OVER (PARTITION BY user_idx ORDER BY draw) AS rank FROM (
      {_draws(SEED, "(SELECT user_idx FROM users ANTI JOIN profiles USING (user_idx))", 200, "1.0 AS w FROM vec").replace("count(*) FROM items", "count(*) FROM vec")}))
  JOIN (SELECT user_idx, rank, exp(sum(ln(1.0 - {uniform_sql(f'{SEED}/score', 'user_idx', 'rank')}) / ((SELECT count(*) FROM vec) - rank + 1))
          OVER (PARTITION BY user_idx ORDER BY rank)) AS relevance FROM users, range(1, {K + 1}) t(rank)) USING (user_idx, rank)"""


@query(
    "rec_content",
    with_views(
        ["users", "content_known", "vec"],
        f"""SELECT user_idx, item_idx, round(relevance, 6) AS relevance, rank FROM content_known
            UNION ALL SELECT user_idx, item_idx, round(round(relevance, 9), 6) AS relevance, rank FROM ({_COLD})""",
    ),
)
def rec_content(spark, d):
    """Every user: by profile, or at random where there is none."""
    log, users, _ = inputs(spark, d)
    out = rec.content(log, users, tb.vectors(spark, d), VEC_DIM, K, seed=SEED)
    return out.withColumn("relevance", F.round("relevance", 6))


@query(
    "rec_hybrid",
    with_views(
        ["users", "seen", "ucb_table", "pop_table", "items"],
        f"""SELECT user_idx, item_idx, relevance, rank, category, price, size, brand FROM (
            SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY relevance DESC, item_idx DESC)::INTEGER AS rank FROM (
              SELECT user_idx, item_idx, round(sum(relevance), 11) AS relevance FROM (
                SELECT user_idx, item_idx, relevance * 0.75 AS relevance FROM ({topk_view('SELECT user_idx, item_idx, relevance FROM users CROSS JOIN ucb_table', 2 * K)})
                UNION ALL
                SELECT user_idx, item_idx, relevance * 0.25 FROM ({topk_view('SELECT user_idx, item_idx, relevance FROM users CROSS JOIN pop_table', 2 * K)}))
              GROUP BY 1, 2) JOIN items USING (item_idx)) WHERE rank <= {K}""",
    ),
)
def rec_hybrid(spark, d):
    log, users, items = inputs(spark, d)
    lists = [rec.ucb(log, users, items, 2 * K), rec.popularity(log, users, items, 2 * K)]
    return rec.hybrid(lists, items, K, [3.0, 1.0])


@query(
    "rec_neutral",
    with_views(["users", "items", "seen"], topk_view("SELECT user_idx, item_idx, 0.5::DOUBLE AS relevance FROM users CROSS JOIN items")),
)
def rec_neutral(spark, d):
    log, users, items = inputs(spark, d)
    return rec.neutral(users, items, log, K)


_N, _S = rec.NGRAM, rec.NGRAM_SMOOTHING
_NGRAM = f"""WITH g AS (SELECT prev_2, prev_1, item_idx, count(*) AS n FROM (
     SELECT user_idx, item_idx, lag(item_idx, 1) OVER w AS prev_1, lag(item_idx, 2) OVER w AS prev_2 FROM seq
     WINDOW w AS (PARTITION BY user_idx ORDER BY pos)) WHERE prev_2 IS NOT NULL GROUP BY 1, 2, 3),
  ct AS (SELECT prev_2, prev_1, sum(n) AS total FROM g GROUP BY 1, 2),
  uni AS (SELECT item_idx, sum(n) AS n FROM g GROUP BY 1),
  lastc AS (SELECT user_idx, max(item_idx) FILTER (pos = length - 1) AS prev_2, max(item_idx) FILTER (pos = length) AS prev_1 FROM seq GROUP BY user_idx),
  pref AS (SELECT user_idx, category, count(*) AS n FROM log JOIN items USING (item_idx) GROUP BY 1, 2),
  ptot AS (SELECT user_idx, sum(n) AS total, count(*) AS kinds FROM pref GROUP BY 1),
  u AS (SELECT user_idx, (SELECT count(*) FROM items) - history.items AS c, prev_2, prev_1, ct.total AS ctx, ptot.total AS pt, kinds
        FROM history LEFT JOIN lastc USING (user_idx) LEFT JOIN ct USING (prev_2, prev_1) LEFT JOIN ptot USING (user_idx)),
  s AS (SELECT user_idx, item_idx, round(price * (0.7::DOUBLE * CASE WHEN ctx IS NOT NULL THEN (coalesce(g.n, 0) + {_S}::DOUBLE) / (ctx + {_S}::DOUBLE * c)
             ELSE (coalesce(uni.n, 0) + {_S}::DOUBLE) / ((SELECT sum(n) FROM uni) + {_S}::DOUBLE * c) END
           + 0.3::DOUBLE * CASE WHEN pt IS NULL THEN 0.5 ELSE (coalesce(pref.n, 0) + {_S}::DOUBLE) / (pt + {_S}::DOUBLE * kinds) END), 9) AS relevance
        FROM u CROSS JOIN items LEFT JOIN uni USING (item_idx) LEFT JOIN g USING (prev_2, prev_1, item_idx) LEFT JOIN pref USING (user_idx, category))
""" + topk_view("SELECT * FROM s")


@query("rec_ngram_revenue", with_views(["seq", "items", "history", "seen"], _NGRAM).replace("\nWITH g AS", ",\ng AS"))
def rec_ngram_revenue(spark, d):
    log, users, items = inputs(spark, d)
    return rec.ngram_revenue(log, users, items, K, tb.SEQUENCE_ORDER, tb.day())


_U_NUM, _I_NUM = ["income"], ["price", "size"]
_COLUMNS = [*_U_NUM, *_I_NUM, "bias"]
VIEWS["nodes"] = (
    ("users", "items"),
    """SELECT row_number() OVER (ORDER BY user_idx) - 1 AS node, user_idx, NULL::BIGINT AS item_idx,
              (income - avg(income) OVER ()) / stddev_pop(income) OVER () AS income, 0.0::DOUBLE AS price, 0.0::DOUBLE AS size, 1.0::DOUBLE AS bias FROM users
       UNION ALL SELECT row_number() OVER (ORDER BY item_idx) - 1 + (SELECT count(*) FROM users), NULL, item_idx, 0.0,
              (price - avg(price) OVER ()) / stddev_pop(price) OVER (), (size - avg(size) OVER ()) / stddev_pop(size) OVER (), 1.0 FROM items""",
)
VIEWS["both_ways"] = (("edges",), "SELECT src, dst, w FROM edges UNION ALL SELECT dst, src, w FROM edges")


def _hop(source: str, e: str, deg: str) -> str:
    got = ", ".join(f"sum(w * x.{c} / sqrt(du.deg)) AS {c}" for c in _COLUMNS)
    new = ", ".join(f"x.{c} / d.deg + coalesce(g.{c}, 0.0) / sqrt(d.deg) AS {c}" for c in _COLUMNS)
    return f"""SELECT x.node, {new} FROM {source} x JOIN {deg} d USING (node) LEFT JOIN (
        SELECT dst AS node, {got} FROM {e} JOIN {source} x ON x.node = src JOIN {deg} du ON du.node = src GROUP BY dst) g USING (node)"""


for _name, _e in (("one_way", "edges"), ("two_way", "both_ways")):
    VIEWS[f"deg_{_name}"] = (("nodes", _e), f"SELECT node, 1.0 + coalesce(w, 0.0) AS deg FROM nodes LEFT JOIN (SELECT dst AS node, sum(w) AS w FROM {_e} GROUP BY 1) USING (node)")
    VIEWS[f"hop1_{_name}"] = (("nodes", _e, f"deg_{_name}"), _hop("nodes", _e, f"deg_{_name}"))
    VIEWS[f"hop2_{_name}"] = ((f"hop1_{_name}", _e, f"deg_{_name}"), _hop(f"hop1_{_name}", _e, f"deg_{_name}"))


def _rounded(columns, digits):
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


@query("graph_propagation", with_views(["hop1_one_way"], f"SELECT node, {_rounded(_COLUMNS, 6)} FROM hop1_one_way"))
def graph_propagation(spark, d):
    out = rec.graph_embeddings(*inputs(spark, d), _U_NUM, _I_NUM, hops=1, symmetric=False)
    return out.select("node", *[F.round(c, 6).alias(c) for c in _COLUMNS])


@query("graph_propagation_symmetric", with_views(["hop2_two_way"], f"SELECT node, {_rounded(_COLUMNS, 6)} FROM hop2_two_way"))
def graph_propagation_symmetric(spark, d):
    out = rec.graph_embeddings(*inputs(spark, d), _U_NUM, _I_NUM, hops=2)
    return out.select("node", *[F.round(c, 6).alias(c) for c in _COLUMNS])


_DOT = " + ".join(f"round(a.{c}, 9) * (round(b.{c}, 9) * price)" for c in _COLUMNS)


@query(
    "rec_graph_revenue",
    with_views(
        ["hop2_two_way", "items", "seen"],
        topk_view(
            f"""SELECT user_idx, item_idx, round({_DOT}, 6) AS relevance FROM (SELECT h.*, user_idx FROM hop2_two_way h JOIN nodes USING (node) WHERE user_idx IS NOT NULL) a
                CROSS JOIN (SELECT h.*, n.item_idx, i.price AS price FROM hop2_two_way h JOIN (SELECT node, item_idx FROM nodes) n USING (node) JOIN (SELECT item_idx, price AS price FROM items) i USING (item_idx)) b"""
        ).replace("h.*, n.item_idx, i.price AS price", "h.* RENAME (price AS price_f), n.item_idx, i.price AS price").replace("round(b.price, 9)", "round(b.price_f, 9)")
        .replace(" * price)", " * b.price)"),
    ),
)
def rec_graph_revenue(spark, d):
    return rec.graph_revenue(*inputs(spark, d), _U_NUM, _I_NUM, K, digits=6)


# --- nearest neighbours ---------------------------------------------------------------------


@query(
    "knn_join",
    with_views(
        ["pairs"],
        """SELECT qid, row_id, round(distance, 6) AS distance, rank::INTEGER AS rank FROM (
             SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(distance, 9), row_id DESC) AS rank FROM (
               SELECT c.label AS qid, e.vec_id AS row_id, list_distance(c.b, e.embedding::DOUBLE[]) AS distance
               FROM (SELECT DISTINCT label, center AS b FROM embeddings JOIN (SELECT label, [""" + ", ".join(f"avg(embedding[{i + 1}]::DOUBLE)" for i in range(VEC_DIM))
        + """] AS center FROM embeddings GROUP BY label) USING (label)) c CROSS JOIN embeddings e)) WHERE rank <= 20""",
    ),
)
def knn_join(spark, d):
    """The 20 vectors nearest to the centre of each label."""
    centers = vector_pairs(spark, d).groupBy("label").agg(F.first("b").alias("vec")).select(F.col("label").cast("long").alias("qid"), "vec")
    train = tb.vectors(spark, d).withColumnRenamed("item_idx", "row_id")
    near = rec.neighbours(centers, train, 20)
    return near.select(F.col("qid").cast("int").alias("qid"), "row_id", F.round("distance", 6).alias("distance"), "rank")


def knn_inputs(spark, d):
    """The pairs of the log, the parts of a point that users and items give (standardized numbers), and the training rows."""
    log, users, items = inputs(spark, d)
    u = feat.standard_scaled(users.select("user_idx", "income"), ["income"])
    i = feat.standard_scaled(items.select("item_idx", "price", "size"), ["price", "size"])
    pairs = durable(log.groupBy("user_idx", "item_idx").agg(F.max("relevance").alias("label")))
    train = pairs.join(u, "user_idx").join(i, "item_idx").select(
        F.concat_ws(":", "user_idx", "item_idx").alias("row_id"), F.array("income", "price", "size").alias("vec"), "label"
    )
    return pairs, u.select("user_idx", F.array("income").alias("vec")), i.select("item_idx", F.array("price", "size").alias("vec")), train


_SCALED = "({0} - (SELECT avg({0}) FROM {1})) / (SELECT stddev_pop({0}) FROM {1})"
VIEWS["user_points"] = (("users",), f"SELECT user_idx, {_SCALED.format('income', 'users')} AS x FROM users")
VIEWS["item_points"] = (("items",), f"SELECT item_idx, {_SCALED.format('price', 'items')} AS y, {_SCALED.format('size', 'items')} AS z FROM items")
# rows are numbered by their text id, in which ties of the distance are broken
VIEWS["points"] = (
    ("log", "user_points", "item_points"),
    """SELECT user_idx || ':' || item_idx AS row_id, row_number() OVER (ORDER BY user_idx || ':' || item_idx) AS row_no, x, y, z, label
       FROM (SELECT user_idx, item_idx, max(relevance) AS label FROM log GROUP BY ALL)
       JOIN user_points USING (user_idx) JOIN item_points USING (item_idx)""",
)
# distance in 1e-9, row (the larger first) and label of a training row t seen from a point c, in one number
NEAR_SQL = """round(sqrt((c.x - t.x) * (c.x - t.x) + (c.y - t.y) * (c.y - t.y) + (c.z - t.z) * (c.z - t.z)) * 1e9)::BIGINT * 2097152
              + (1048575 - t.row_no) * 2 + t.label"""
FAR_SQL, LABEL_SQL = "((n // 2097152) / 1e9)", "(n % 2)"


@query(
    "rec_knn",
    # every user's first 30 unseen items in descending order hold 10 items of the highest score, so no other can enter
    with_views(
        ["user_points", "item_points", "points", "seen"],
        f"""SELECT user_idx, item_idx, relevance, rank::INTEGER AS rank FROM (
              SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY relevance DESC, item_idx DESC) AS rank FROM (
                SELECT user_idx, item_idx, round_even(list_sum(list_transform(near, lambda n: {LABEL_SQL} / ({FAR_SQL} + 1e-10)))
                         / list_sum(list_transform(near, lambda n: 1 / ({FAR_SQL} + 1e-10))), 0) AS relevance
                FROM (SELECT c.user_idx, c.item_idx, min({NEAR_SQL}, 5) AS near
                      FROM (SELECT * FROM (
                              SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY item_idx DESC) AS o FROM user_points CROSS JOIN item_points
                              WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_idx = user_points.user_idx AND s.item_idx = item_points.item_idx))
                            WHERE o <= 30) c CROSS JOIN points t GROUP BY ALL))) WHERE rank <= {K}""",
    ),
)
def rec_knn(spark, d):
    """Ten out of all unseen items."""
    log, users, items, train = knn_inputs(spark, d)
    return rec.knn_catalogue(users, items, train, log, K, 5, cell_items=1024)


# --- streaming ------------------------------------------------------------------------------


@query(
    "stream_item_stats",
    with_views(
        ["counts"],
        """SELECT item_idx, pos, total, round(pos / total + sqrt(ln(2.0 * (SELECT count(*) FROM lineitem)) / total), 9) AS ucb,
                  round((pos + 1.0) / (total + 2.0), 9) AS popularity FROM counts""",
    ),
)
def stream_item_stats(spark, d):
    schema = tb.table(spark, d, "lineitem").schema
    lines = read_log(spark, f"{d.rstrip('/')}/lineitem*.parquet", schema)
    log = lines.select(F.col("l_partkey").alias("item_idx"), tb.kept("l_returnflag").alias("relevance"))
    out = streaming_scores(item_stats_stream(log))
    return out.select("item_idx", "pos", "total", F.round("ucb", 9).alias("ucb"), F.round("popularity", 9).alias("popularity"))
