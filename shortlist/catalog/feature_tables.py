"""Feature tables, windows, sequences, vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from shortlist.catalog.base import VIEWS, query, with_views
from shortlist.functions import vectors as vec
from shortlist.operators import features as feat
from shortlist.operators.sequences import Sequences
from shortlist.plans.ordering import global_row_number, positions
from shortlist.plans.topk import best_first
from shortlist.session import durable
from shortlist.operators import popularity as pop
from shortlist.sources import tables as tb

_ROUND = 6


def _rounded(df, digits: int = _ROUND):
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


VIEWS["ufeat"] = (
    ("log", "users"),
    """SELECT user_idx, segment AS u_segment, income AS u_income, u_user_interaction_count, u_user_avg_relevance,
              u_user_relevance_std, u_user_max_relevance FROM users LEFT JOIN (
         SELECT user_idx, count(*) AS u_user_interaction_count, avg(relevance) AS u_user_avg_relevance,
                stddev_samp(relevance) AS u_user_relevance_std, max(relevance) AS u_user_max_relevance FROM log GROUP BY 1) USING (user_idx)""",
)
VIEWS["ifeat"] = (
    ("log", "items"),
    """SELECT item_idx, category AS i_category, price AS i_price, size AS i_size, brand AS i_brand, i_item_popularity,
              i_item_avg_relevance, i_item_relevance_std, i_item_max_relevance, i_category_avg_relevance, i_category_popularity
       FROM items LEFT JOIN (
         SELECT item_idx, count(*) AS i_item_popularity, avg(relevance) AS i_item_avg_relevance,
                stddev_samp(relevance) AS i_item_relevance_std, max(relevance) AS i_item_max_relevance FROM log GROUP BY 1) USING (item_idx)
       LEFT JOIN (SELECT category, avg(relevance) AS i_category_avg_relevance, count(*) AS i_category_popularity
                  FROM log JOIN items USING (item_idx) GROUP BY 1) USING (category)""",
)
VIEWS["joined"] = (
    ("log", "ufeat", "ifeat"),
    """SELECT * FROM (SELECT user_idx, item_idx, relevance FROM log) JOIN ufeat USING (user_idx) JOIN ifeat USING (item_idx)""",
)
_DOUBLES = [
    "u_income", "u_user_avg_relevance", "u_user_relevance_std", "i_price", "i_item_avg_relevance", "i_item_relevance_std",
    "i_category_avg_relevance",
]


def joined(spark, d):
    return feat.joined_features(tb.interactions(spark, d), tb.users(spark, d), tb.items(spark, d))


@query(
    "aggregate_features",
    with_views(["joined"], "SELECT * REPLACE (" + ", ".join(f"round({c}, 6) AS {c}" for c in _DOUBLES) + ") FROM joined"),
)
def aggregate_features(spark, d):
    return _rounded(joined(spark, d)).withColumn("i_category_popularity", F.col("i_category_popularity").cast("long"))


@query(
    "price_vs_user_mean",
    with_views(
        ["log", "items"],
        """SELECT user_idx, item_idx, i_price, i_category, round(avg(i_price) OVER (PARTITION BY i_category), 9) AS avg_category_price,
                  round(avg(i_price) OVER (PARTITION BY user_idx), 9) AS user_avg_price,
                  round(i_price - avg(i_price) OVER (PARTITION BY user_idx), 9) AS price_vs_user_mean
           FROM (SELECT user_idx, item_idx, price AS i_price, category AS i_category FROM log JOIN items USING (item_idx))""",
    ),
)
def price_vs_user_mean(spark, d):
    items = feat.prefixed(tb.items(spark, d).select("item_idx", "price", "category"), "i_", "item_idx")
    rows = tb.interactions(spark, d).select("user_idx", "item_idx").join(items, "item_idx")
    return _rounded(feat.price_features(rows, tb.users(spark, d)), 9)


_DIVERSITY = """(SELECT user_idx, count(DISTINCT i_category) AS category_diversity FROM joined GROUP BY 1)"""
_SEGMENTS = """(SELECT item_idx, count(DISTINCT u_segment) AS item_segments FROM joined GROUP BY 1)"""


@query(
    "segment_category_features",
    with_views(
        ["joined"],
        f"""SELECT user_idx, item_idx, relevance, u_segment, i_category,
                   round(avg(relevance) OVER (PARTITION BY user_idx, i_category), 6) AS category_preference_score,
                   count(relevance) OVER (PARTITION BY user_idx, i_category) AS category_exploration_score,
                   round(avg(relevance) OVER (PARTITION BY u_segment, i_category), 6) AS segment_category_strength,
                   category_diversity, item_segments
            FROM joined JOIN {_DIVERSITY} USING (user_idx) JOIN {_SEGMENTS} USING (item_idx)""",
    ),
)
def segment_category_features(spark, d):
    users, items = tb.users(spark, d), tb.items(spark, d)
    rows = tb.interactions(spark, d).select("user_idx", "item_idx", "relevance")
    rows = rows.join(users.select("user_idx", F.col("segment").alias("u_segment")), "user_idx")
    rows = rows.join(items.select("item_idx", F.col("category").alias("i_category")), "item_idx")
    # stored: the statistics and the joins read it several times
    return _rounded(feat.segment_category_features(durable(rows), users, items))


_LEVELS = ["very_low", "low", "medium", "high", "very_high"]
_P = [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]


def _level_sql(column: str, edges: str) -> str:
    """``edges`` is a list-valued column; unusable edges give 'medium'."""
    steps = " ".join(f"WHEN {column} <= {edges}[{i + 2}] THEN '{name}'" for i, name in enumerate(_LEVELS))
    bad = " OR ".join(f"{edges}[{i + 1}] >= {edges}[{i + 2}]" for i in range(5))
    return f"CASE WHEN {bad} THEN 'medium' WHEN {column} IS NULL THEN NULL {steps} END"


@query(
    "quantile_bins",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, {_level_sql('l_extendedprice', 'e')} AS price_range, {_level_sql('l_tax', 't')} AS tax_range
        FROM lineitem, (SELECT quantile_cont(l_extendedprice, {_P}) AS e, quantile_cont(l_tax, {_P}) AS t FROM lineitem)""",
)
def quantile_bins(spark, d):
    lines = tb.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_tax")
    out = feat.quantile_level(lines, "l_extendedprice", "price_range")
    return feat.quantile_level(out, "l_tax", "tax_range", over=lines).drop("l_extendedprice", "l_tax")


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_POWERS = ", ".join(
    f"{c} ** {p} AS {c}_{n}"
    for c in ("u_income", "i_price", "u_user_avg_relevance", "i_item_avg_relevance") for p, n in ((2, "squared"), (3, "cubed"))
)
_INTERACTION = f"""
SELECT * EXCLUDE (pe, ae, oe), concat_ws('_', price_range, i_category) AS price_category_match FROM (
 SELECT j.*, i_price / (u_income + 1) AS price_sensitivity, u_income / (i_price + 1) AS price_affordability,
  i_price * u_income AS price_income_interaction, i_price / (u_income + 1) * (u_income / (i_price + 1)) AS price_elasticity,
  avg(i_price / (u_income + 1)) OVER (PARTITION BY u_segment) AS segment_price_sensitivity,
  avg(relevance) OVER (PARTITION BY user_idx, i_category) AS category_preference_score,
  count(relevance) OVER (PARTITION BY user_idx, i_category) AS category_exploration_score,
  avg(relevance) OVER (PARTITION BY u_segment, i_category) AS segment_category_strength, category_diversity,
  {_level_sql('i_price', 'pe')} AS price_range, {_level_sql('u_user_interaction_count', 'ae')} AS user_activity_level,
  {_level_sql('i_item_popularity', 'oe')} AS item_popularity_level,
  u_user_interaction_count * u_user_avg_relevance AS user_engagement_score,
  u_user_interaction_count / category_diversity AS user_exploration_score,
  i_item_popularity * i_item_avg_relevance AS item_engagement_score, i_item_popularity / item_segments AS item_diversity_score,
  {", ".join(f"CASE WHEN u_segment = '{s}' THEN u_income / (i_price + 1) ELSE 0.0 END AS segment_{s}_price_match" for s in SEGMENTS)},
  {_POWERS}, pe, ae, oe
 FROM joined j JOIN {_DIVERSITY} USING (user_idx) JOIN {_SEGMENTS} USING (item_idx),
  (SELECT quantile_cont(i_price, {_P}) AS pe, quantile_cont(u_user_interaction_count, {_P}) AS ae,
          quantile_cont(i_item_popularity, {_P}) AS oe FROM joined))"""


_EXACT = [
    "user_idx", "item_idx", "relevance", "u_segment", "u_user_interaction_count", "u_user_max_relevance", "i_category", "i_size",
    "i_brand", "i_item_popularity", "i_item_max_relevance", "category_exploration_score", "category_diversity", "price_range",
    "user_activity_level", "item_popularity_level", "price_category_match",
]
# values of very different size: rounded to a fixed number of digits each
_DIGITS = {
    **dict.fromkeys(_DOUBLES, 6), "price_sensitivity": 6, "price_affordability": 6, "price_income_interaction": 4,
    "price_elasticity": 6, "segment_price_sensitivity": 6, "category_preference_score": 6, "segment_category_strength": 6,
    "user_engagement_score": 4, "user_exploration_score": 6, "item_engagement_score": 4, "item_diversity_score": 6,
    **{f"segment_{x}_price_match": 6 for x in SEGMENTS}, "u_income_squared": 4, "i_price_squared": 2,
    "u_user_avg_relevance_squared": 6, "u_user_avg_relevance_cubed": 6, "i_item_avg_relevance_squared": 6,
    "i_item_avg_relevance_cubed": 6, "u_income_cubed": -3, "i_price_cubed": -2,
}


@query(
    "interaction_features",
    with_views(
        ["joined"],
        "SELECT " + ", ".join(_EXACT) + ", i_category_popularity, " + ", ".join(f"round({c}, {n}) AS {c}" for c, n in _DIGITS.items())
        + f" FROM ({_INTERACTION})",
    ),
)
def interaction_features(spark, d):
    out = feat.interaction_features(joined(spark, d), tb.users(spark, d), tb.items(spark, d))
    return out.select(
        *_EXACT, F.col("i_category_popularity").cast("long"), *[F.round(c, n).alias(c) for c, n in _DIGITS.items()]
    )


# fixed: the categories of the item table
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(
    "one_hot_pivot",
    with_views(
        ["items"],
        "SELECT item_idx, " + ", ".join(f"(category = '{c}')::INTEGER::DOUBLE AS category_{c}" for c in TYPES) + " FROM items",
    ),
)
def one_hot_pivot(spark, d):
    return feat.one_hot(tb.items(spark, d).select("item_idx", "category"), "category", TYPES).drop("category")


@query(
    "standard_scale",
    with_views(
        ["items"],
        """SELECT item_idx, round((price - avg(price) OVER ()) / stddev_pop(price) OVER (), 6) AS price,
                  round((size - avg(size) OVER ()) / stddev_pop(size) OVER (), 6) AS size FROM items""",
    ),
)
def standard_scale(spark, d):
    return _rounded(feat.standard_scaled(tb.items(spark, d).select("item_idx", "price", "size"), ["price", "size"]))


@query(
    "label_encode",
    with_views(
        ["items", "log"],
        """SELECT item_idx, brand, coalesce(code, 0) AS code FROM items LEFT JOIN (
             SELECT brand, row_number() OVER (ORDER BY brand) - 1 AS code
             FROM (SELECT DISTINCT brand FROM items SEMI JOIN (SELECT item_idx FROM log WHERE iter <= 1998) USING (item_idx)))
           USING (brand)""",
    ),
)
def label_encode(spark, d):
    """Codes learned on the items of the training years, applied to all: unseen brands get 0."""
    items = tb.items(spark, d)
    past = tb.interactions(spark, d).filter(F.col("iter") <= tb.LAST_TRAIN_YEAR)
    codes = feat.label_codes(items.join(past, "item_idx", "left_semi"), "brand")
    return feat.label_encoded(items.select("item_idx", "brand"), "brand", codes)


# --- sequences ------------------------------------------------------------------------------

VIEWS["event_seq"] = (
    (),
    """SELECT user_id, event_type, event_id, row_number() OVER w AS pos, count(*) OVER (PARTITION BY user_id) AS length,
              lag(event_type, 1) OVER w AS prev_1, lag(event_type, 2) OVER w AS prev_2
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)


def event_sequences(spark, d) -> Sequences:
    events = tb.table(spark, d, "events").select("user_id", "event_type", "event_id", "ts")
    return Sequences(events, ["ts", "event_id"], tb.day(), user="user_id", item="event_type")


@query(
    "ngram_contexts",
    with_views(["event_seq"], "SELECT user_id, event_id, event_type, pos, prev_1, prev_2 FROM event_seq WHERE prev_2 IS NOT NULL"),
)
def ngram_contexts(spark, d):
    out = event_sequences(spark, d).contexts(2)
    return out.select("user_id", "event_id", "event_type", "pos", "prev_1", "prev_2")


@query(
    "ngram_counts",
    with_views(["event_seq"], """SELECT prev_2 || '>' || prev_1 AS context, event_type AS item_idx, count(*) AS n
        FROM event_seq WHERE prev_2 IS NOT NULL GROUP BY 1, 2"""),
)
def ngram_counts(spark, d):
    return event_sequences(spark, d).ngrams(2).withColumn("context", F.array_join("context", ">"))


@query(
    "next_item_counts",
    with_views(["event_seq"], "SELECT event_type AS item_idx, count(*) AS n FROM event_seq WHERE pos > 2 GROUP BY 1"),
)
def next_item_counts(spark, d):
    return event_sequences(spark, d).next_items(2)


@query(
    "last_context",
    with_views(["event_seq"], """SELECT user_id, string_agg(event_type, '>' ORDER BY pos) AS context FROM event_seq
        WHERE length >= 2 AND pos > length - 2 GROUP BY 1"""),
)
def last_context(spark, d):
    return event_sequences(spark, d).last_contexts(2).withColumn("context", F.array_join("context", ">"))


@query(
    "sequence_position",
    with_views(["seq"], "SELECT user_idx, item_idx, l_orderkey, l_linenumber, pos FROM seq"),
)
def sequence_position(spark, d):
    log = tb.interactions(spark, d).select("user_idx", "item_idx", "l_orderkey", "l_linenumber", "ts")
    return positions(log, "user_idx", tb.SEQUENCE_ORDER, tb.day()).drop("ts")


@query(
    "padded_sequences",
    with_views(
        ["seq"],
        """SELECT user_idx, length, unnest(range(20))::INTEGER AS place,
                  unnest(list_concat(list_resize([]::BIGINT[], 20 - len(s), 0), s)) AS item_idx
           FROM (SELECT user_idx, max(length) AS length, list(item_idx ORDER BY pos) AS s FROM seq WHERE pos > length - 20 GROUP BY 1)""",
    ),
)
def padded_sequences(spark, d):
    log = tb.interactions(spark, d).select("user_idx", "item_idx", "l_orderkey", "l_linenumber", "ts")
    out = Sequences(log, tb.SEQUENCE_ORDER, tb.day()).padded(20)
    return out.select("user_idx", "length", F.posexplode("sequence").alias("place", "item_idx"))


@query(
    "global_item_rank",
    with_views(["ucb_table"], "SELECT item_idx, relevance, row_number() OVER (ORDER BY relevance DESC, item_idx DESC) AS rank FROM ucb_table"),
)
def global_item_rank(spark, d):
    scores = pop.ucb_table(tb.item_log(spark, d), tb.items(spark, d)).withColumn("relevance", F.round("relevance", 9))
    return global_row_number(scores, best_first())


@query(
    "top_items_per_category",
    with_views(
        ["ucb_table", "items"],
        """SELECT category, item_idx, relevance, rank::INTEGER AS rank FROM (
             SELECT *, row_number() OVER (PARTITION BY category ORDER BY relevance DESC, item_idx DESC) AS rank
             FROM ucb_table JOIN items USING (item_idx)) WHERE rank <= 5""",
    ),
)
def top_items_per_category(spark, d):
    scores = pop.ucb_table(tb.item_log(spark, d), tb.items(spark, d)).withColumn("relevance", F.round("relevance", 9))
    both = scores.join(tb.items(spark, d).select("item_idx", "category"), "item_idx")
    return feat.first_by_group(both, "category", best_first(), 5)


# --- vectors: each item vector against the mean vector of its label ---------------------------

_DIM = 64
VIEWS["pairs"] = (
    (),
    "SELECT vec_id, embedding::DOUBLE[] AS a, center AS b FROM embeddings JOIN (SELECT label, ["
    + ", ".join(f"avg(embedding[{i + 1}]::DOUBLE)" for i in range(_DIM))
    + "] AS center FROM embeddings GROUP BY label) USING (label)",
)


def vector_pairs(spark, d):
    e = tb.table(spark, d, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("a"))
    center = e.groupBy("label").agg(F.array(*[F.avg(F.get("a", F.lit(i))) for i in range(_DIM)]).alias("b"))
    return e.join(center, "label")


@query("vector_dot", with_views(["pairs"], "SELECT vec_id, round(list_inner_product(a, b), 6) AS value FROM pairs"))
def vector_dot(spark, d):
    return vector_pairs(spark, d).select("vec_id", F.round(vec.dot("a", "b"), 6).alias("value"))


@query("vector_cosine", with_views(["pairs"], "SELECT vec_id, round(list_cosine_similarity(a, b), 6) AS value FROM pairs"))
def vector_cosine(spark, d):
    return vector_pairs(spark, d).select("vec_id", F.round(vec.cosine("a", "b"), 6).alias("value"))


@query(
    "vector_angular",
    with_views(["pairs"], "SELECT vec_id, round(1.0 - acos(greatest(least(list_cosine_similarity(a, b), 1.0), -1.0)) / pi(), 6) AS value FROM pairs"),
)
def vector_angular(spark, d):
    return vector_pairs(spark, d).select("vec_id", F.round(vec.angular("a", "b"), 6).alias("value"))


@query(
    "vector_distances",
    with_views(
        ["pairs"],
        """SELECT vec_id, round(list_distance(a, b), 6) AS euclidean,
                  round(list_sum(list_transform(list_zip(a, b), lambda x: abs(x[1] - x[2]))), 6) AS manhattan,
                  round(1.0 - list_cosine_similarity(a, b), 6) AS cosine,
                  round(list_sum(list_transform(list_zip(a, b), lambda x: abs(x[1] - x[2]) ** 3)) ** (1.0::DOUBLE / 3), 6) AS minkowski FROM pairs""",
    ),
)
def vector_distances(spark, d):
    named = {name: F.round(fn("a", "b"), 6) for name, fn in vec.DISTANCES.items()}
    return vector_pairs(spark, d).withColumns({**named, "minkowski": F.round(vec.minkowski("a", "b", 3), 6)}).drop("a", "b", "label")


@query(
    "vector_normalize",
    """SELECT vec_id, unnest(range(64))::INTEGER AS dim, round(unnest(list_transform(embedding::DOUBLE[],
              lambda v: v / sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])))), 6) AS value FROM embeddings""",
)
def vector_normalize(spark, d):
    unit = vec.normalized(F.col("embedding").cast("array<double>"))
    return tb.table(spark, d, "embeddings").select("vec_id", F.posexplode(unit).alias("dim", "value")).withColumn("value", F.round("value", 6))


@query("vector_element", "SELECT vec_id, round(embedding[4]::DOUBLE, 9) AS value FROM embeddings")
def vector_element(spark, d):
    return tb.table(spark, d, "embeddings").select("vec_id", F.round(F.get("embedding", F.lit(3)).cast("double"), 9).alias("value"))


@query(
    "vector_sum_scale",
    with_views(["pairs"], """SELECT vec_id, unnest(range(64))::INTEGER AS dim,
        round(unnest(list_transform(list_zip(a, b), lambda x: x[1] * 2.0 + x[2])), 6) AS value FROM pairs"""),
)
def vector_sum_scale(spark, d):
    out = vector_pairs(spark, d).select("vec_id", vec.added(vec.scaled("a", F.lit(2.0)), "b").alias("v"))
    return out.select("vec_id", F.posexplode("v").alias("dim", "value")).withColumn("value", F.round("value", 6))


@query(
    "price_score",
    with_views(
        ["items"],
        """SELECT item_idx, round((sin(p) + 1) * exp(p - 1) * ln(1 + price) * cos(price / 100) * (1 + tan(p * pi() / 4)), 6) AS score
           FROM (SELECT *, size / 50.0::DOUBLE AS p FROM items)""",
    ),
)
def price_score(spark, d):
    """The composite score of the margin model, here with the scaled size as the probability."""
    items = tb.items(spark, d).withColumn("p", F.col("size") / 50.0)
    return items.select("item_idx", F.round(feat.price_score(F.col("p"), F.col("price")), 6).alias("score"))
