"""Aggregates and dataset profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from shortlist.catalog.base import K, SEED, VIEWS, query, with_views
from shortlist.functions.randomness import uniform, uniform_sql
from shortlist.operators import features as feat
from shortlist.operators import popularity as pop, profile as prof
from shortlist.operators.impute import Fill
from shortlist.plans.ordering import exact_percentiles
from shortlist.sources import tables as tb

CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
VEC_DIM = 64


def _r(df, *columns, digits: int = 9):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("item_counts", with_views(["counts"], "SELECT * FROM counts"))
def item_counts(spark, d):
    return pop.item_counts(tb.item_log(spark, d))


@query("item_popularity", with_views(["counts"], "SELECT item_idx, round((pos + 1.0) / (total + 2.0), 9) AS relevance FROM counts"))
def item_popularity(spark, d):
    return _r(pop.smoothed_popularity(pop.item_counts(tb.item_log(spark, d))), "relevance")


@query("ucb_scores", with_views(["ucb"], "SELECT item_idx, pos, total, round(relevance, 9) AS relevance FROM ucb"))
def ucb_scores(spark, d):
    return _r(pop.ucb_scores(pop.item_counts(tb.item_log(spark, d))), "relevance")


def _stats_sql(key: str, count: str, prefix: str) -> str:
    return with_views(
        ["log"],
        f"""SELECT {key}, count(*) AS {count}, round(avg(relevance), 9) AS {prefix}_avg_relevance,
            round(stddev_samp(relevance), 9) AS {prefix}_relevance_std, max(relevance) AS {prefix}_max_relevance FROM log GROUP BY {key}""",
    )


@query("user_stats", _stats_sql("user_idx", "user_interaction_count", "user"))
def user_stats(spark, d):
    return _r(feat.user_stats(tb.interactions(spark, d)), "user_avg_relevance", "user_relevance_std")


@query("item_stats", _stats_sql("item_idx", "item_popularity", "item"))
def item_stats(spark, d):
    return _r(feat.item_stats(tb.item_log(spark, d)), "item_avg_relevance", "item_relevance_std")


@query(
    "category_stats",
    with_views(["log", "items"], """SELECT category, round(avg(relevance), 9) AS category_avg_relevance,
        count(*) AS category_popularity FROM log JOIN items USING (item_idx) GROUP BY 1"""),
)
def category_stats(spark, d):
    return _cast(_r(feat.category_stats(tb.item_log(spark, d), tb.items(spark, d)), "category_avg_relevance"), "category_popularity")


def _cast(df, *columns, to: str = "long"):
    return df.withColumns({c: F.col(c).cast(to) for c in columns})


@query("history_length", with_views(["history"], "SELECT user_idx, items FROM history"))
def history_length(spark, d):
    return pop.history_sizes(tb.interactions(spark, d), tb.users(spark, d))


@query("max_history_length", with_views(["history"], "SELECT coalesce(max(items), 0) AS max_items FROM history"))
def max_history_length(spark, d):
    return pop.max_history(tb.interactions(spark, d), tb.users(spark, d))


@query(
    "score_share",
    with_views(["ucb"], "SELECT item_idx, round(relevance / (SELECT sum(relevance) FROM ucb), 12) AS probability FROM ucb"),
)
def score_share(spark, d):
    shares = pop.score_share(pop.ucb_scores(pop.item_counts(tb.item_log(spark, d))))
    return shares.select("item_idx", F.round("probability", 12).alias("probability"))


_SUMS = ", ".join(f"sum(relevance * vec[{i + 1}]) AS s{i}" for i in range(VEC_DIM))
_PROFILE = ", ".join(f"CASE WHEN weight > 0 THEN s{i} / weight ELSE 0.0 END" for i in range(VEC_DIM))
VIEWS["profiles"] = (
    ("log", "vec"),
    f"""SELECT user_idx, interactions, weight, [{_PROFILE}] AS vec FROM (
          SELECT user_idx, count(*) AS interactions, sum(relevance)::DOUBLE AS weight, {_SUMS}
          FROM log JOIN vec USING (item_idx) GROUP BY user_idx)""",
)


@query(
    "user_profiles",
    with_views(
        ["profiles"],
        "SELECT user_idx, interactions, weight, unnest(range(64))::INTEGER AS dim, round(unnest(vec), 6) AS value FROM profiles",
    ),
)
def user_profiles(spark, d):
    out = prof.user_profiles(tb.interactions(spark, d), tb.vectors(spark, d), VEC_DIM)
    return out.select("user_idx", "interactions", "weight", F.posexplode("vec").alias("dim", "value")).withColumn(
        "value", F.round("value", 6)
    )


@query(
    "log_statistics",
    with_views(
        ["log"],
        """WITH n AS (SELECT user_idx, count(*) AS n FROM log GROUP BY 1)
           SELECT sum(n)::BIGINT AS total_interactions, count(*) AS unique_users, round(avg(n), 9) AS avg_interactions_per_user,
                  max(n) AS max_interactions_per_user, count(*) FILTER (n > 1) AS users_with_multiple,
                  round(count(*) FILTER (n > 1) * 100.0 / count(*), 9) AS pct_users_with_multiple,
                  (SELECT count(DISTINCT item_idx) FROM log) AS unique_items FROM n""",
    ).replace("\nWITH n AS", ", n AS"),
)
def log_statistics(spark, d):
    return _r(prof.log_statistics(tb.interactions(spark, d)), "avg_interactions_per_user", "pct_users_with_multiple")


@query(
    "sequence_length_hist",
    with_views(["log"], "SELECT n AS length, count(*) AS users FROM (SELECT count(*) AS n FROM log GROUP BY user_idx) GROUP BY n"),
)
def sequence_length_hist(spark, d):
    return prof.sequence_lengths(tb.interactions(spark, d))


@query(
    "segment_share",
    with_views(["users"], "SELECT segment, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM users), 9) AS pct FROM users GROUP BY 1"),
)
def segment_share(spark, d):
    return _r(prof.share_pct(tb.users(spark, d), "segment"), "pct")


@query(
    "category_share",
    with_views(["items"], "SELECT category, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM items), 9) AS pct FROM items GROUP BY 1"),
)
def category_share(spark, d):
    return _r(prof.share_pct(tb.items(spark, d), "category"), "pct")


@query(
    "coverage",
    with_views(
        ["log", "users", "items"],
        """SELECT interactions, active_users, active_items,
                  round(interactions * 100.0::DOUBLE / (nu * ni), 9) AS density_pct,
                  round(active_users * 100.0::DOUBLE / nu, 9) AS user_coverage_pct,
                  round(active_items * 100.0::DOUBLE / ni, 9) AS item_coverage_pct
           FROM (SELECT count(*) AS interactions, count(DISTINCT user_idx) AS active_users, count(DISTINCT item_idx) AS active_items FROM log),
                (SELECT count(*) AS nu FROM users), (SELECT count(*) AS ni FROM items)""",
    ),
)
def coverage(spark, d):
    out = prof.coverage(tb.interactions(spark, d), tb.users(spark, d), tb.items(spark, d))
    return _r(out, "density_pct", "user_coverage_pct", "item_coverage_pct")


@query(
    "interactions_distribution",
    with_views(
        ["log"],
        """SELECT 'user' AS side, n, count(*) AS keys FROM (SELECT count(*) AS n FROM log GROUP BY user_idx) GROUP BY n
           UNION ALL SELECT 'item', n, count(*) FROM (SELECT count(*) AS n FROM log GROUP BY item_idx) GROUP BY n""",
    ),
)
def interactions_distribution(spark, d):
    return prof.interactions_distribution(tb.interactions(spark, d))


@query("relevance_distribution", with_views(["log"], "SELECT relevance, count(*) AS n FROM log GROUP BY 1"))
def relevance_distribution(spark, d):
    return prof.relevance_distribution(tb.item_log(spark, d))


@query(
    "segment_category_pivot",
    with_views(
        ["log", "users", "items"],
        "SELECT segment, " + ", ".join(f"count(*) FILTER (category = '{c}') AS {c}" for c in CATEGORIES)
        + " FROM log JOIN users USING (user_idx) JOIN items USING (item_idx) GROUP BY 1",
    ),
)
def segment_category_pivot(spark, d):
    return prof.segment_category_pivot(tb.interactions(spark, d), tb.users(spark, d), tb.items(spark, d), CATEGORIES)


def _bins(column: str, table: str, bins: int, by: str = "") -> str:
    b = f"{by}, " if by else ""
    return with_views(
        [table],
        f"""SELECT {b}least(floor(({column} - lo) / ((hi - lo) / {bins})), {bins - 1})::BIGINT AS bin, count(*) AS n
            FROM {table}, (SELECT min({column}) AS lo, max({column}) AS hi FROM {table}) GROUP BY ALL""",
    )


@query("price_histogram", _bins("price", "items", 20))
def price_histogram(spark, d):
    return _cast(prof.histogram(tb.items(spark, d), "price", 20), "bin")


@query("income_histogram_by_segment", _bins("income", "users", 10, "segment"))
def income_histogram_by_segment(spark, d):
    return _cast(prof.histogram(tb.users(spark, d), "income", 10, "segment"), "bin")


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "feature_correlation",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
        for i, a in enumerate(_CORR) for b in _CORR[i:]
    ),
)
def feature_correlation(spark, d):
    return _r(prof.correlations(tb.table(spark, d, "lineitem"), _CORR), "corr", digits=6)


_POINTS = [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]


@query(
    "price_percentiles",
    " UNION ALL ".join(
        f"SELECT {p}::DOUBLE AS point, round(quantile_cont(l_extendedprice, {p}), 6) AS value FROM lineitem" for p in _POINTS
    ),
)
def price_percentiles(spark, d):
    return _r(exact_percentiles(tb.table(spark, d, "lineitem"), "l_extendedprice", _POINTS), "value", digits=6)


_PER_YEAR = """SELECT iter, count(*) AS unique_users, sum(n)::BIGINT AS total_interactions, avg(n) AS avg_interactions_per_user,
    count(*) FILTER (n > 1) * 100.0::DOUBLE / count(*) AS pct_users_with_multiple FROM (
    SELECT iter, user_idx, count(*) AS n FROM log GROUP BY 1, 2) GROUP BY 1"""


@query(
    "suitability_label",
    with_views(
        ["log"],
        f"""SELECT iter, unique_users, total_interactions, round(avg_interactions_per_user * pct_users_with_multiple / 100, 6) AS score,
                CASE WHEN avg_interactions_per_user >= 2.5 AND pct_users_with_multiple >= 30 THEN 'Good'
                     WHEN avg_interactions_per_user >= 2.0 AND pct_users_with_multiple >= 20 THEN 'Moderate' ELSE 'Poor' END AS label
            FROM ({_PER_YEAR})""",
    ),
)
def suitability_label(spark, d):
    stats = prof.log_statistics(tb.interactions(spark, d).select("iter", "user_idx", "item_idx"), ["iter"])
    return _r(prof.suitability(stats), "score", digits=6).select("iter", "unique_users", "total_interactions", "score", "label")


@query(
    "best_configuration",
    with_views(["log"], f"""SELECT iter AS best FROM ({_PER_YEAR})
        ORDER BY avg_interactions_per_user * pct_users_with_multiple DESC, iter DESC LIMIT 1"""),
)
def best_configuration(spark, d):
    return prof.best_configuration(prof.log_statistics(tb.interactions(spark, d), ["iter"]), "iter")


@query(
    "category_preferences",
    with_views(["log", "items"], "SELECT user_idx, category, count(*) AS n FROM log JOIN items USING (item_idx) GROUP BY 1, 2"),
)
def category_preferences(spark, d):
    return prof.category_preferences(tb.interactions(spark, d), tb.items(spark, d))


@query(
    "category_item_counts",
    with_views(["log", "items"], "SELECT item_idx, category, count(*) AS n FROM log JOIN items USING (item_idx) GROUP BY 1, 2"),
)
def category_item_counts(spark, d):
    return prof.category_preferences(tb.item_log(spark, d), tb.items(spark, d), "item_idx")


@query(
    "impute_values",
    """(SELECT 'p_type' AS "column", p_type AS value FROM part GROUP BY p_type ORDER BY count(*) DESC, p_type LIMIT 1)
       UNION ALL (SELECT 'p_brand', p_brand FROM part GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 1)
       UNION ALL SELECT 'p_size', round(avg(p_size), 6)::VARCHAR FROM part""",
)
def impute_values(spark, d):
    return feat.impute_values(tb.table(spark, d, "part"), ["p_type", "p_brand"], ["p_size"])


_HOLES = {"category": "p_type", "brand": "p_brand", "size": "p_size", "price": "p_retailprice"}


@query(
    "imputed_items",
    "WITH holes AS (SELECT p_partkey AS item_idx, "
    + ", ".join(f"CASE WHEN {uniform_sql(f'{SEED}/hole {c}', 'p_partkey')} >= 0.2 THEN {source} END AS {c}" for c, source in _HOLES.items())
    + " FROM part) SELECT item_idx, "
    + ", ".join(f"coalesce({c}, (SELECT {c} FROM holes WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}" for c in ("category", "brand"))
    + ", " + ", ".join(f"round(coalesce({c}::DOUBLE, (SELECT avg({c}) FROM holes)), 6) AS {c}" for c in ("size", "price"))
    + " FROM holes",
)
def imputed_items(spark, d):
    """Items of which a fifth of the values is missing, filled by what the rest of the table says."""
    gaps = [F.when(uniform(f"{SEED}/hole {c}", "p_partkey") >= 0.2, F.col(source)).alias(c) for c, source in _HOLES.items()]
    holes = tb.table(spark, d, "part").select(F.col("p_partkey").alias("item_idx"), *gaps)
    filled = Fill(textCols=["category", "brand"], numericCols=["size", "price"]).fit(holes).transform(holes)
    return filled.withColumns({c: F.round(c, 6) for c in ("size", "price")})


@query(
    "top_spenders",
    with_views(["log"], "SELECT user_idx, round(sum(revenue), 2) AS revenue FROM log GROUP BY 1 ORDER BY 2 DESC, 1 DESC LIMIT 10"),
)
def top_spenders(spark, d):
    """Global top-k of an aggregate: sorted and cut in each task first."""
    spent = tb.interactions(spark, d).groupBy("user_idx").agg(F.round(F.sum("revenue"), 2).alias("revenue"))
    return spent.orderBy(F.col("revenue").desc(), F.col("user_idx").desc()).limit(K)
