"""Response columns, and metrics of recommenders on what users kept after the years they were fitted on."""

from __future__ import annotations

from pyspark.sql import functions as F

from shortlist.catalog.base import K, SEED, VIEWS, query, with_views
from shortlist.catalog.feature_tables import vector_pairs
from shortlist.catalog.sampling import make_items
from shortlist.catalog.tables_and_joins import ucb_recs
from shortlist.functions.randomness import gamma_int_sql, normal_sql, uniform_sql
from shortlist.operators import evaluation as ev
from shortlist.operators import metrics as mt
from shortlist.operators import popularity as pop
from shortlist.operators import profile as prof
from shortlist.operators import recommend as rec
from shortlist.operators import response as rs
from shortlist.plans.skew import lookup
from shortlist.sources import tables as tb

AT = 5


#: the first years tell models apart before the last ones judge them
PHASES = [ev.Phase("train", 1996, tb.LAST_TRAIN_YEAR), ev.Phase("test", tb.LAST_TRAIN_YEAR)]
MODELS: dict[str, ev.Recommender] = {
    "popularity": lambda log, users, items, k: rec.popularity(log, users, items, k),
    "ucb": lambda log, users, items, k: rec.ucb(log, users, items, k),
    "ucb_price": lambda log, users, items, k: rec.ucb_price(log, users, items, k),
    "popularity_revenue": lambda log, users, items, k: rec.expected_revenue(pop.popularity_table(log, items), items, users, log, k),
    "ucb_revenue": lambda log, users, items, k: rec.expected_revenue(pop.ucb_table(log, items), items, users, log, k),
}
_UCB = "coalesce(pos / c.total + sqrt(ln(2.0 * n) / c.total), 1.0 + sqrt(ln(2.0 * n)))"
_POP = "coalesce((pos + 1.0) / (c.total + 2.0), 0.5)"
_MODEL_SQL = {
    "popularity": _POP, "ucb": _UCB, "ucb_price": f"{_UCB} + 0.3::DOUBLE * (price - lo) / (hi - lo)",
    "popularity_revenue": f"{_POP} * price", "ucb_revenue": f"{_UCB} * price",
}
_SCORES = " UNION ALL ".join(
    f"SELECT phase, '{m}' AS model, item_idx, round({e}, 9) AS relevance FROM phases CROSS JOIN items CROSS JOIN (SELECT min(price) AS lo, max(price) AS hi FROM items) "
    f"JOIN fitted_rows USING (phase) LEFT JOIN fitted_counts c USING (phase, item_idx)"
    for m, e in _MODEL_SQL.items()
)
VIEWS["phases"] = ((), "SELECT * FROM (VALUES " + ", ".join(f"('{p.name}', {p.fitted}, {p.judged or 9999})" for p in PHASES) + ") p(phase, fitted, until)")
VIEWS["fitted_log"] = (("log", "phases"), "SELECT phase, log.* FROM log JOIN phases ON iter <= fitted")
VIEWS["later_log"] = (("log", "phases"), "SELECT phase, log.* FROM log JOIN phases ON iter > fitted AND iter <= until")
VIEWS["fitted_rows"] = (("fitted_log",), "SELECT phase, count(*) AS n FROM fitted_log GROUP BY phase")
VIEWS["fitted_seen"] = (("fitted_log",), "SELECT DISTINCT phase, user_idx, item_idx FROM fitted_log")
VIEWS["fitted_counts"] = (("fitted_log",), "SELECT phase, item_idx, sum(relevance)::BIGINT AS pos, count(relevance) AS total FROM fitted_log GROUP BY ALL")
# no list reaches further down than its length and the longest history
VIEWS["model_heads"] = (
    ("items", "phases", "fitted_rows", "fitted_counts", "fitted_seen"),
    f"""SELECT phase, model, item_idx, relevance FROM (
          SELECT *, row_number() OVER (PARTITION BY phase, model ORDER BY relevance DESC, item_idx DESC) AS place FROM ({_SCORES}))
        WHERE place <= {K} + (SELECT max(h) FROM (SELECT count(*) AS h FROM fitted_seen GROUP BY phase, user_idx))""",
)
VIEWS["model_lists"] = (
    ("users", "model_heads", "fitted_seen"),
    f"""SELECT * FROM (
          SELECT phase, model, user_idx, item_idx, relevance,
                 row_number() OVER (PARTITION BY phase, model, user_idx ORDER BY relevance DESC, item_idx DESC) AS rank
          FROM users CROSS JOIN model_heads h ANTI JOIN fitted_seen s USING (phase, user_idx, item_idx)) WHERE rank <= {K}""",
)


def _judged_sql(by: str, only: str = "") -> str:
    return f"""SELECT l.*, {by} coalesce(k.response, 0) AS response, coalesce(k.revenue, 0.0) AS revenue
        FROM model_lists l JOIN (SELECT DISTINCT {by} phase, user_idx FROM later_log) a USING (phase, user_idx)
        LEFT JOIN (SELECT {by} phase, user_idx, item_idx, max(CASE WHEN relevance > 0 THEN 1 ELSE 0 END) AS response,
                          sum(CASE WHEN relevance > 0 THEN revenue ELSE 0.0 END) AS revenue FROM later_log GROUP BY ALL) k
        USING ({by} phase, user_idx, item_idx) {only}"""


VIEWS["model_judged"] = (("model_lists", "later_log"), _judged_sql("iter,"))
VIEWS["kept_later"] = (("model_lists", "later_log"), _judged_sql("", "WHERE phase = 'test' AND model = 'ucb'"))


def kept_later(spark, d):
    """The confidence-bound lists of the training years against all that was kept after them."""
    log, users, items = tb.interactions(spark, d), tb.users(spark, d), tb.items(spark, d)
    last = [PHASES[-1]]
    return ev.judged(ev.lists_of({"ucb": MODELS["ucb"]}, log, users, items, K, last), log, last, ())


def model_metrics(spark, d):
    return ev.compare(MODELS, tb.interactions(spark, d), tb.users(spark, d), tb.items(spark, d), K, AT, PHASES)


# --- responses ------------------------------------------------------------------------------


@query(
    "responses",
    with_views(["responses"], "SELECT user_idx, item_idx, relevance, rank, round(__noisy_relevance, 9) AS p, response, round(revenue, 6) AS revenue FROM responses"),
)
def responses(spark, d):
    """The chain as ML transformers."""
    both = rs.with_features(ucb_recs(spark, d), tb.users(spark, d), tb.items(spark, d))
    out = rs.response_model(SEED).transform(both)
    return out.select(
        "user_idx", "item_idx", "relevance", "rank", F.round("__noisy_relevance", 9).alias("p"), "response", F.round("revenue", 6).alias("revenue")
    )


_KEY = ["l_orderkey", "l_linenumber", "l_partkey"]
_LINES = "l_orderkey, l_linenumber, l_partkey"


def _lines(spark, d, *more):
    return tb.table(spark, d, "lineitem").select(*_KEY, *more)


@query(
    "response_bernoulli",
    f"""SELECT {_LINES}, l_discount, CASE WHEN {uniform_sql(f'{SEED}/response', *_KEY)} <= l_discount * 5 THEN 1 ELSE 0 END AS response FROM lineitem""",
)
def response_bernoulli(spark, d):
    lines = _lines(spark, d, "l_discount").withColumn("p", F.col("l_discount") * 5)
    return rs.bernoulli(lines, "p", "response", SEED, _KEY).drop("p")


@query(
    "response_noise",
    f"""SELECT {_LINES}, round(greatest({normal_sql(f'{SEED}/noise', *_KEY, mean=0.1, std=0.05)}, 0.0), 9) AS noise FROM lineitem""",
)
def response_noise(spark, d):
    return rs.noise(_lines(spark, d), output="noise", seed=SEED, key=_KEY).withColumn("noise", F.round("noise", 9))


@query("response_constant", f"SELECT {_LINES}, 0.25::DOUBLE AS response FROM lineitem")
def response_constant(spark, d):
    return rs.constant(_lines(spark, d), 0.25)


@query(
    "response_cosine",
    with_views(["pairs"], "SELECT vec_id, round(1.0 - acos(greatest(least(list_cosine_similarity(a, b), 1.0), -1.0)) / pi(), 6) AS response FROM pairs"),
)
def response_cosine(spark, d):
    return rs.angular(vector_pairs(spark, d), ["a", "b"]).select("vec_id", F.round("response", 6).alias("response"))


@query("response_weighted", f"SELECT {_LINES}, round(l_discount * 0.7 + l_tax * 0.3, 6) AS response FROM lineitem")
def response_weighted(spark, d):
    out = rs.weighted(_lines(spark, d, "l_discount", "l_tax"), ["l_discount", "l_tax"], [0.7, 0.3])
    return out.select(*_KEY, F.round("response", 6).alias("response"))


@query(
    "response_revenue",
    with_views(["items"], """SELECT l_orderkey, l_linenumber, item_idx, response, round(response * price, 6) AS revenue FROM (
        SELECT l_orderkey, l_linenumber, l_partkey AS item_idx, CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END::BIGINT AS response FROM lineitem)
        JOIN items USING (item_idx)"""),
)
def response_revenue(spark, d):
    lines = tb.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("item_idx"), tb.kept("l_returnflag").alias("response")
    )
    out = rs.revenue(lookup(lines, tb.items(spark, d).select("item_idx", "price"), "item_idx"))
    return out.select("l_orderkey", "l_linenumber", "item_idx", "response", F.round("revenue", 6).alias("revenue"))


# --- ranking metrics ------------------------------------------------------------------------

_HEAD = f"(SELECT * FROM kept_later WHERE rank <= {AT})"
METRIC_SQL = {
    "precision_at_k": f"SELECT round(avg(v), 9) AS precision_at_k FROM (SELECT avg(response) AS v FROM {_HEAD} GROUP BY user_idx)",
    "ndcg_at_k": f"""SELECT round(avg(dcg / ideal), 9) AS ndcg_at_k FROM (
        SELECT sum(response / log2(given + 1)) AS dcg, sum(response / log2(best + 1)) AS ideal FROM (
          SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY rank) AS given,
                 row_number() OVER (PARTITION BY user_idx ORDER BY response DESC) AS best FROM {_HEAD}) GROUP BY user_idx) WHERE ideal > 0""",
    "mrr": """SELECT round(avg(v), 9) AS mrr FROM (
        SELECT coalesce(1.0::DOUBLE / min(CASE WHEN response > 0 THEN rank END), 0.0) AS v FROM kept_later GROUP BY user_idx)""",
    "hit_rate": f"SELECT round(avg(v), 9) AS hit_rate FROM (SELECT max(CASE WHEN response > 0 THEN 1.0 ELSE 0.0 END)::DOUBLE AS v FROM {_HEAD} GROUP BY user_idx)",
    "discounted_revenue": f"SELECT round(sum(revenue / log2(rank + 1)), 2) AS discounted_revenue FROM {_HEAD}",
    "total_revenue": "SELECT round(sum(revenue), 2) AS total_revenue FROM kept_later",
    "conversion_rate": "SELECT round(avg(response), 9) AS conversion_rate FROM kept_later",
    "factor_dcg": f"SELECT round(avg(v), 9) AS factor_dcg FROM (SELECT sum(relevance * 0.85::DOUBLE ** (rank - 1)) AS v FROM {_HEAD} GROUP BY user_idx)",
}


def _metric(name: str, fn, digits: int):
    @query(name, with_views(["kept_later"], METRIC_SQL[name]))
    def run(spark, d):
        return fn(kept_later(spark, d)).withColumn(name, F.round(name, digits))

    return run


for _name, _fn, _digits in (
    ("precision_at_k", lambda r: mt.precision_at_k(r, AT), 9),
    ("ndcg_at_k", lambda r: mt.ndcg_at_k(r, AT), 9),
    ("mrr", mt.mrr, 9),
    ("hit_rate", lambda r: mt.hit_rate(r, AT), 9),
    ("discounted_revenue", lambda r: mt.discounted_revenue(r, AT), 2),
    ("total_revenue", mt.total_revenue, 2),
    ("conversion_rate", mt.conversion_rate, 9),
    ("factor_dcg", lambda r: mt.factor_dcg(r, AT), 9),
):
    _metric(_name, _fn, _digits)


@query(
    "recall_at_k",
    with_views(
        ["recs", "users", "items", "log"],
        f"""SELECT round(avg(v), 9) AS recall_at_k FROM (
              SELECT user_idx, sum(CASE WHEN rank IS NULL THEN 0 ELSE 1 END) / count(*) AS v
              FROM (SELECT DISTINCT user_idx, item_idx FROM log WHERE relevance > 0) t
              LEFT JOIN (SELECT user_idx, item_idx, rank FROM users CROSS JOIN (
                 SELECT item_idx, row_number() OVER (ORDER BY relevance DESC, item_idx DESC) AS rank FROM pop_all) WHERE rank <= 50) r
              USING (user_idx, item_idx) GROUP BY user_idx)""".replace(
            "pop_all",
            """(SELECT item_idx, round(coalesce((pos + 1.0) / (total + 2.0), 0.5), 9) AS relevance FROM items LEFT JOIN (
                 SELECT item_idx, sum(relevance)::BIGINT AS pos, count(relevance) AS total FROM log GROUP BY 1) USING (item_idx))""",
        ),
    ),
)
def recall_at_k(spark, d):
    """The 50 most popular items against the items each user kept; seen items stay in the lists."""
    log = tb.interactions(spark, d)
    recs = rec.popularity(log, tb.users(spark, d), tb.items(spark, d), 50, filter_seen=False)
    return mt.recall_at_k(recs, log.filter(F.col("relevance") > 0), 50).withColumn("recall_at_k", F.round("recall_at_k", 9))


# --- several recommenders, year by year ----------------------------------------------------------

VIEWS["model_metrics"] = (
    ("model_judged",),
    f"""WITH h AS (SELECT *, row_number() OVER (PARTITION BY model, phase, iter, user_idx ORDER BY rank) AS given,
                row_number() OVER (PARTITION BY model, phase, iter, user_idx ORDER BY response DESC) AS best FROM model_judged WHERE rank <= {AT}),
         u AS (SELECT model, phase, iter, user_idx, avg(response) AS p, sum(response / log2(given + 1)) AS dcg, sum(response / log2(best + 1)) AS ideal,
                      max(CASE WHEN response > 0 THEN 1.0 ELSE 0.0 END)::DOUBLE AS hit, sum(revenue / log2(rank + 1)) AS dr FROM h GROUP BY ALL),
         w AS (SELECT model, phase, iter, user_idx, coalesce(1.0::DOUBLE / min(CASE WHEN response > 0 THEN rank END), 0.0) AS rr, sum(revenue) AS t
               FROM model_judged GROUP BY ALL),
         m AS (SELECT model, phase, iter, avg(p) AS precision_at_k, avg(CASE WHEN ideal > 0 THEN dcg / ideal END) AS ndcg_at_k, avg(rr) AS mrr,
                      avg(hit) AS hit_rate, sum(dr) AS discounted_revenue, sum(t) AS total_revenue
               FROM u JOIN w USING (model, phase, iter, user_idx) GROUP BY ALL)
         SELECT * FROM m UNPIVOT INCLUDE NULLS (value FOR metric IN (precision_at_k, ndcg_at_k, mrr, hit_rate, discounted_revenue, total_revenue))""",
)
_BIG = "metric IN ('discounted_revenue', 'total_revenue')"


@query(
    "metric_trajectory",
    with_views(["model_metrics"], f"SELECT model, phase, iter, metric, CASE WHEN {_BIG} THEN round(value, 2) ELSE round(value, 9) END AS value FROM model_metrics"),
)
def metric_trajectory(spark, d):
    big = F.col("metric").isin("discounted_revenue", "total_revenue")
    return model_metrics(spark, d).withColumn("value", F.when(big, F.round("value", 2)).otherwise(F.round("value", 9)))


_METRICS = ["precision_at_k", "ndcg_at_k", "mrr", "hit_rate", "discounted_revenue"]
_BOARD = "SELECT model, " + ", ".join(
    [f"sum(value) FILTER (metric = 'total_revenue' AND phase = '{p}') AS {p}_total_revenue" for p in ("train", "test")]
    + [f"avg(value) FILTER (metric = 'total_revenue' AND phase = '{p}') AS {p}_avg_revenue" for p in ("train", "test")]
    + [f"avg(value) FILTER (metric = '{m}' AND phase = '{p}') AS {p}_{m}" for p in ("train", "test") for m in _METRICS]
) + " FROM model_metrics GROUP BY model"
VIEWS["board"] = (
    ("model_metrics",), f"SELECT *, (test_avg_revenue / CASE WHEN train_avg_revenue <> 0 THEN train_avg_revenue END - 1) * 100 AS change_pct FROM ({_BOARD})",
)
_BOARD_DIGITS = {
    **{f"{p}_{m}": 6 for p in ("train", "test") for m in _METRICS if m != "discounted_revenue"},
    **{f"{p}_{m}": n for p in ("train", "test") for m, n in (("total_revenue", 2), ("avg_revenue", 4), ("discounted_revenue", 2))}, "change_pct": 6,
}


@query(
    "leaderboard",
    with_views(["board"], "SELECT model, " + ", ".join(f"round({c}, {n}) AS {c}" for c, n in _BOARD_DIGITS.items()) + " FROM board"),
)
def leaderboard(spark, d):
    board = prof.leaderboard(model_metrics(spark, d))
    return board.select("model", *[F.round(c, n).alias(c) for c, n in _BOARD_DIGITS.items()])


@query(
    "train_test_comparison",
    with_views(["board"], """SELECT model, round(train_total_revenue, 2) AS train_total_revenue, round(test_total_revenue, 2) AS test_total_revenue,
        round(change_pct, 6) AS change_pct FROM board"""),
)
def train_test_comparison(spark, d):
    board = prof.leaderboard(model_metrics(spark, d))
    return board.select(
        "model", F.round("train_total_revenue", 2).alias("train_total_revenue"), F.round("test_total_revenue", 2).alias("test_total_revenue"),
        F.round("change_pct", 6).alias("change_pct"),
    )


_CORR_METRICS = ["precision_at_k", "mrr", "hit_rate", "discounted_revenue"]


@query(
    "metric_correlation",
    with_views(
        ["model_metrics"],
        "SELECT a, b, round(corr, 6) AS corr FROM ("
        + " UNION ALL ".join(
            f"SELECT '{a}' AS a, '{b}' AS b, corr(x.value, y.value) AS corr FROM model_metrics x JOIN model_metrics y USING (model, phase, iter) WHERE x.metric = '{a}' AND y.metric = '{b}'"
            for i, a in enumerate(_CORR_METRICS) for b in _CORR_METRICS[i:]
        )
        + ")",
    ),
)
def metric_correlation(spark, d):
    wide = model_metrics(spark, d).groupBy("model", "phase", "iter").pivot("metric", _CORR_METRICS).agg(F.first("value"))
    return prof.correlations(wide, _CORR_METRICS).withColumn("corr", F.round("corr", 6))


# --- predictions against labels: discount-based score of each line against "kept" -------------

VIEWS["scored"] = (
    (),
    """SELECT l_extendedprice / 105000.0::DOUBLE AS prediction, CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END::DOUBLE AS label,
              l_quantity / 50.0::DOUBLE AS q FROM lineitem""",
)


def scored(spark, d):
    return tb.table(spark, d, "lineitem").select(
        (F.col("l_extendedprice") / 105000.0).alias("prediction"), tb.kept("l_returnflag").cast("double").alias("label"),
        (F.col("l_quantity") / 50.0).alias("q"),
    )


@query(
    "regression_metrics",
    with_views(
        ["scored"],
        """SELECT round(sqrt(mse), 9) AS rmse, round(mse, 9) AS mse, round(mae, 9) AS mae, round(1 - mse / spread, 9) AS r2, round(var, 9) AS var FROM (
             SELECT avg((label - prediction) ** 2) AS mse, avg(abs(label - prediction)) AS mae, var_pop(label) AS spread,
                    avg((prediction - (SELECT avg(label) FROM scored)) ** 2) AS var FROM scored)""",
    ),
)
def regression_metrics(spark, d):
    out = mt.regression_metrics(scored(spark, d), "prediction", "label")
    return out.select(*[F.round(c, 9).alias(c) for c in out.columns])


_CONFUSION = """c AS (SELECT (prediction >= 0.5)::INTEGER::DOUBLE AS p, label AS y FROM scored),
 l AS (SELECT DISTINCT y AS label FROM c),
 m AS (SELECT label, (SELECT count(*) FROM c WHERE y = label) AS actual, (SELECT count(*) FROM c WHERE p = label) AS predicted,
              (SELECT count(*) FROM c WHERE y = label AND p = label) AS tp, (SELECT count(*) FROM c) AS total FROM l),
 r AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS prec, tp / actual AS rec, (predicted - tp) / (total - actual) AS fpr FROM m),
 f AS (SELECT *, CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0 END AS f FROM r)"""


def _crisp(spark, d):
    return scored(spark, d).select((F.col("prediction") >= 0.5).cast("int").cast("double").alias("p"), F.col("label").alias("y"))


@query(
    "multiclass_metrics",
    with_views(["scored"], "SELECT * FROM x").replace("\nSELECT * FROM x", f",\n{_CONFUSION}\n") + """
      SELECT round(sum(tp) / max(total), 9) AS accuracy, round(1 - sum(tp) / max(total), 9) AS "hammingLoss", round(sum(f * actual / total), 9) AS f1,
             round(sum(prec * actual / total), 9) AS "weightedPrecision", round(sum(rec * actual / total), 9) AS "weightedRecall",
             round(sum(rec * actual / total), 9) AS "weightedTruePositiveRate", round(sum(fpr * actual / total), 9) AS "weightedFalsePositiveRate",
             round(sum(f * actual / total), 9) AS "weightedFMeasure" FROM f""",
)
def multiclass_metrics(spark, d):
    out = mt.multiclass_summary(_crisp(spark, d), "p", "y")
    return out.select(*[F.round(c, 9).alias(c) for c in out.columns])


@query(
    "metrics_by_label",
    with_views(["scored"], "SELECT * FROM x").replace("\nSELECT * FROM x", f",\n{_CONFUSION}\n")
    + "SELECT label, actual::BIGINT AS actual, tp::BIGINT AS tp, round(prec, 9) AS precision, round(rec, 9) AS recall, round(fpr, 9) AS fpr, round(f, 9) AS f FROM f",
)
def metrics_by_label(spark, d):
    out = mt.multiclass_metrics(_crisp(spark, d), "p", "y").drop("total")
    return out.select("label", "actual", "tp", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "fpr", "f")])


@query(
    "log_loss",
    with_views(["scored"], """SELECT round(avg(-ln(greatest(least(CASE WHEN label > 0 THEN prediction ELSE 1 - prediction END, 1 - 1e-15), 1e-15))), 9) AS "logLoss" FROM scored"""),
)
def log_loss(spark, d):
    return mt.log_loss(scored(spark, d), "prediction", "label").select(F.round("logLoss", 9).alias("logLoss"))


@query(
    "binary_auc",
    with_views(
        ["scored"],
        """SELECT round((sum(r) FILTER (label > 0) - n1 * (n1 + 1) / 2) / (n1 * n0), 9) AS "areaUnderROC" FROM (
             SELECT label, (rank() OVER (ORDER BY q) + (count(*) OVER (PARTITION BY q) - 1) / 2) AS r,
                    sum(label) OVER () AS n1, sum(1 - label) OVER () AS n0 FROM scored) GROUP BY n1, n0""",
    ),
)
def binary_auc(spark, d):
    return mt.area_under_roc(scored(spark, d), "q", "label").select(F.round("areaUnderROC", 9).alias("areaUnderROC"))


@query(
    "binary_area_under_pr",
    with_views(
        ["scored"],
        """SELECT round(sum((tp - tp0) / n1 * (tp / (tp + fp) + CASE WHEN tp0 + fp0 > 0 THEN tp0 / (tp0 + fp0) ELSE tp / (tp + fp) END) / 2), 9) AS "areaUnderPR"
           FROM (SELECT q, tp, fp, n1, coalesce(lag(tp) OVER (ORDER BY q DESC), 0) AS tp0, coalesce(lag(fp) OVER (ORDER BY q DESC), 0) AS fp0
                 FROM (SELECT q, sum(sum(label)) OVER (ORDER BY q DESC) AS tp, sum(sum(1 - label)) OVER (ORDER BY q DESC) AS fp,
                              (SELECT sum(label) FROM scored) AS n1 FROM scored GROUP BY q))""",
    ),
)
def binary_area_under_pr(spark, d):
    return mt.area_under_pr(scored(spark, d), "q", "label").select(F.round("areaUnderPR", 9).alias("areaUnderPR"))


_KS = """SELECT max(abs(x / nx - y / ny)) FROM (
   SELECT v, sum(sum(a)) OVER (ORDER BY v) AS x, sum(sum(b)) OVER (ORDER BY v) AS y, (SELECT count(*) FROM A) AS nx, (SELECT count(*) FROM B) AS ny
   FROM (SELECT v, 1 AS a, 0 AS b FROM A UNION ALL SELECT v, 0, 1 FROM B) GROUP BY v)"""


def _ks_sql(a: str, b: str) -> str:
    return _KS.replace("FROM A", f"FROM ({a})").replace("FROM B", f"FROM ({b})")


_EXP = "SELECT l_extendedprice / 105000.0::DOUBLE AS v FROM lineitem"
_QTY = "SELECT l_quantity / 50.0::DOUBLE AS v FROM lineitem"


@query("ks_statistic", f"SELECT round(({_ks_sql(_EXP, _QTY)}), 9) AS ks")
def ks_statistic(spark, d):
    rows = scored(spark, d)
    return mt.ks_statistic(rows.select("prediction"), rows.select("q")).select(F.round("ks", 9).alias("ks"))


def _kl_sql(p: str, y: str) -> str:
    return f"""SELECT 1.0::DOUBLE / (1.0::DOUBLE + sum(o * ln(o / e) - o + e)) FROM (
      SELECT i, coalesce(sum(o), 0)::DOUBLE + 1e-5::DOUBLE AS o, coalesce(sum(e), 0)::DOUBLE + 1e-5::DOUBLE AS e FROM range(10) t(i) LEFT JOIN (
        SELECT least(floor((v - lo) / ((hi - lo) / 10)), 9)::BIGINT AS i, o, e
        FROM (SELECT v, 0 AS o, 1 AS e FROM ({p}) UNION ALL SELECT v, 1, 0 FROM ({y})), (SELECT min(v) AS lo, max(v) AS hi FROM ({y}))
        WHERE v BETWEEN lo AND hi) USING (i) GROUP BY i)"""


@query("kl_normalized", f"SELECT round(({_kl_sql(_EXP, _QTY)}), 12) AS kl")
def kl_normalized(spark, d):
    rows = scored(spark, d)
    return mt.kl_normalized(rows.select("prediction"), rows.select("q")).select(F.round("kl", 12).alias("kl"))


_SYN_PRICE = f"SELECT {gamma_int_sql(f'{SEED}/price', 'i', shape=5, scale=10.0)} * 20 AS v FROM range((SELECT count(*) FROM part)) t(i)"
_REAL_PRICE = "SELECT p_retailprice AS v FROM part"


@query(
    "synthetic_quality",
    f"""SELECT 'price' AS "column", 'ks' AS metric, round(1 - ({_ks_sql(_SYN_PRICE, _REAL_PRICE)}), 9) AS value
        UNION ALL SELECT 'price', 'kl', round(({_kl_sql(_SYN_PRICE, _REAL_PRICE)}), 12)""",
)
def synthetic_quality(spark, d):
    """Prices of the synthetic items, scaled by 20, against the real ones."""
    fake = make_items(spark, d).select((F.col("price") * 20).alias("price"))
    out = mt.synthetic_quality(fake, tb.items(spark, d).select("price"), ["price"])
    return out.withColumn("value", F.when(F.col("metric") == "kl", F.round("value", 12)).otherwise(F.round("value", 9)))


@query(
    "evaluate_by_name",
    with_views(
        ["scored"],
        f"""SELECT 'rmse' AS metric, round(sqrt(avg((label - prediction) ** 2)), 9) AS value FROM scored
            UNION ALL SELECT 'mae', round(avg(abs(label - prediction)), 9) FROM scored
            UNION ALL SELECT 'accuracy', round(avg((label = (prediction >= 0.5)::INTEGER)::INTEGER), 9) FROM scored
            UNION ALL SELECT 'kstest', round(({_ks_sql(_EXP, "SELECT CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END::DOUBLE AS v FROM lineitem")}), 9)""",
    ),
)
def evaluate_by_name(spark, d):
    out = mt.evaluate(scored(spark, d), ["rmse", "mae", "accuracy", "kstest"])
    return out.withColumn("value", F.round("value", 9))
