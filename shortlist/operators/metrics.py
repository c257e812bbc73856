"""Ranking, revenue, regression, classification and distribution metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shortlist.plans.ordering import ONE_TASK_ROWS, running_totals

FACTOR = 0.85
KL_BINS, KL_EPSILON = 10, 1e-5


def ensure_rank(recs: DataFrame, order=None) -> DataFrame:
    """Use the given rank, or number each user's list by relevance."""
    if "rank" in recs.columns:
        return recs
    order = order or [F.col("relevance").desc(), F.col("item_idx").desc()]
    return recs.withColumn("rank", F.row_number().over(Window.partitionBy("user_idx").orderBy(*order)))


def _mean_over_users(per_user: DataFrame, name: str, column: str = "v") -> DataFrame:
    return per_user.agg(F.avg(column).alias(name))


def precision_at_k(recs: DataFrame, k: int) -> DataFrame:
    per_user = recs.filter(F.col("rank") <= k).groupBy("user_idx").agg(F.avg("response").alias("v"))
    return _mean_over_users(per_user, "precision_at_k")


def ndcg_at_k(recs: DataFrame, k: int) -> DataFrame:
    """Users whose first k have no positive response are left out."""
    head = recs.filter(F.col("rank") <= k)
    given = Window.partitionBy("user_idx").orderBy("rank", "item_idx")
    best = Window.partitionBy("user_idx").orderBy(F.col("response").desc())
    placed = head.select(
        "user_idx", "response", F.row_number().over(given).alias("at"), F.row_number().over(best).alias("ideal_at")
    )
    per_user = placed.groupBy("user_idx").agg(
        F.sum(F.col("response") / F.log2(F.col("at") + 1)).alias("dcg"),
        F.sum(F.col("response") / F.log2(F.col("ideal_at") + 1)).alias("ideal"),
    )
    return _mean_over_users(per_user.filter(F.col("ideal") > 0).withColumn("v", F.col("dcg") / F.col("ideal")), "ndcg_at_k")


def mrr(recs: DataFrame) -> DataFrame:
    """Over the full list; a user without a positive response counts 0."""
    first = F.min(F.when(F.col("response") > 0, F.col("rank")))
    per_user = recs.groupBy("user_idx").agg(F.coalesce(1.0 / first, F.lit(0.0)).alias("v"))
    return _mean_over_users(per_user, "mrr")


def hit_rate(recs: DataFrame, k: int) -> DataFrame:
    hit = F.max(F.when(F.col("response") > 0, 1.0).otherwise(0.0))
    return _mean_over_users(recs.filter(F.col("rank") <= k).groupBy("user_idx").agg(hit.alias("v")), "hit_rate")


def discounted_revenue(recs: DataFrame, k: int) -> DataFrame:
    gain = F.col("revenue") / F.log2(F.col("rank") + 1)
    return recs.filter(F.col("rank") <= k).agg(F.coalesce(F.sum(gain), F.lit(0.0)).alias("discounted_revenue"))


def total_revenue(recs: DataFrame) -> DataFrame:
    return recs.agg(F.sum("revenue").alias("total_revenue"))


def conversion_rate(recs: DataFrame) -> DataFrame:
    return recs.agg(F.avg("response").alias("conversion_rate"))


def recall_at_k(recs: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    """Hits in the first k over the user's relevant items, for users with any."""
    truth = relevant.select("user_idx", "item_idx").distinct()
    hits = recs.filter(F.col("rank") <= k).select("user_idx", "item_idx", F.lit(1).alias("hit"))
    per_user = (
        truth.join(hits, ["user_idx", "item_idx"], "left")
        .groupBy("user_idx")
        .agg((F.sum(F.coalesce("hit", F.lit(0))) / F.count(F.lit(1))).alias("v"))
    )
    return _mean_over_users(per_user, "recall_at_k")


def factor_dcg(recs: DataFrame, k: int, factor: float = FACTOR) -> DataFrame:
    gain = F.col("relevance") * F.pow(F.lit(factor), F.col("rank") - 1)
    return _mean_over_users(recs.filter(F.col("rank") <= k).groupBy("user_idx").agg(F.sum(gain).alias("v")), "factor_dcg")


RANKING = {
    "precision_at_k": precision_at_k,
    "ndcg_at_k": ndcg_at_k,
    "hit_rate": hit_rate,
    "discounted_revenue": discounted_revenue,
    "factor_dcg": factor_dcg,
}


def iteration_metrics(recs: DataFrame, k: int, by: list[str]) -> DataFrame:
    """All ranking and revenue metrics per group of ``by`` (for example the iteration), in long form."""
    key = [*by, "user_idx"]
    given = Window.partitionBy(*key).orderBy("rank", "item_idx")
    best = Window.partitionBy(*key).orderBy(F.col("response").desc())
    first = F.min(F.when(F.col("response") > 0, F.col("rank")))
    whole = recs.groupBy(*key).agg(F.coalesce(1.0 / first, F.lit(0.0)).alias("mrr"), F.sum("revenue").alias("total"))
    head = recs.filter(F.col("rank") <= k).select(
        *key, "response", "revenue", "rank", F.row_number().over(given).alias("at"), F.row_number().over(best).alias("ideal_at")
    )
    head = head.groupBy(*key).agg(
        F.avg("response").alias("precision"),
        F.sum(F.col("response") / F.log2(F.col("at") + 1)).alias("dcg"),
        F.sum(F.col("response") / F.log2(F.col("ideal_at") + 1)).alias("ideal"),
        F.max(F.when(F.col("response") > 0, 1.0).otherwise(0.0)).alias("hit"),
        F.sum(F.col("revenue") / F.log2(F.col("rank") + 1)).alias("discounted"),
    )
    wide = whole.join(head, key, "left").groupBy(*by).agg(
        F.avg("precision").alias("precision_at_k"),
        F.avg(F.when(F.col("ideal") > 0, F.col("dcg") / F.col("ideal"))).alias("ndcg_at_k"),
        F.avg("mrr").alias("mrr"),
        F.avg("hit").alias("hit_rate"),
        F.sum("discounted").alias("discounted_revenue"),
        F.sum("total").alias("total_revenue"),
    )
    return wide.unpivot(by, [c for c in wide.columns if c not in by], "metric", "value")


# --- predictions against labels -------------------------------------------------------------


def regression_metrics(df: DataFrame, prediction: str, label: str) -> DataFrame:
    """rmse, mse, mae, r2 and explained variance in one pass over the rows. r2 of a constant label is null."""
    p, y = F.col(prediction), F.col(label)
    err = y - p
    sums = df.agg(
        F.avg(err * err).alias("mse"), F.avg(F.abs(err)).alias("mae"),
        F.var_pop(y).alias("spread"), F.avg(y).alias("mean_label"),
        F.avg(p).alias("mean_p"), F.avg(p * p).alias("mean_p2"),
    )
    mean = F.col("mean_label")
    return sums.select(
        F.sqrt("mse").alias("rmse"), "mse", "mae", (1.0 - F.try_divide(F.col("mse"), F.col("spread"))).alias("r2"),
        (F.col("mean_p2") - 2.0 * mean * F.col("mean_p") + mean * mean).alias("var"),
    )


def multiclass_metrics(df: DataFrame, prediction: str, label: str, beta: float = 1.0) -> DataFrame:
    """One row per label with its rates, and the weighted averages, from the confusion table."""
    cells = df.groupBy(F.col(prediction).cast("double").alias("p"), F.col(label).cast("double").alias("y")).agg(
        F.count(F.lit(1)).alias("n")
    )
    by_label = cells.select(F.col("y").alias("label"), "n", F.lit(0).alias("m"), F.when(F.col("p") == F.col("y"), F.col("n")).otherwise(0).alias("tp"))
    by_pred = cells.select(F.col("p").alias("label"), F.lit(0).alias("n"), F.col("n").alias("m"), F.lit(0).alias("tp"))
    per = by_label.unionByName(by_pred).groupBy("label").agg(
        F.sum("n").alias("actual"), F.sum("m").alias("predicted"), F.sum("tp").alias("tp")
    )
    total = cells.agg(F.sum("n")).scalar()
    per = per.filter(F.col("actual") > 0).withColumn("total", total)
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    precision, recall = ratio(F.col("tp"), F.col("predicted")), ratio(F.col("tp"), F.col("actual"))
    fp = F.col("predicted") - F.col("tp")
    per = per.select(
        "label", "actual", "total", "tp", precision.alias("precision"), recall.alias("recall"),
        ratio(fp, F.col("total") - F.col("actual")).alias("fpr"),
    )
    b2 = beta * beta
    return per.withColumn(
        "f", ratio((1 + b2) * F.col("precision") * F.col("recall"), b2 * F.col("precision") + F.col("recall"))
    )


def multiclass_summary(df: DataFrame, prediction: str, label: str) -> DataFrame:
    per = multiclass_metrics(df, prediction, label)
    share = F.col("actual") / F.col("total")
    weighted = lambda c: F.sum(F.col(c) * share)
    accuracy = F.sum("tp") / F.max("total")
    return per.agg(
        accuracy.alias("accuracy"), (1.0 - accuracy).alias("hammingLoss"), weighted("f").alias("f1"),
        weighted("precision").alias("weightedPrecision"), weighted("recall").alias("weightedRecall"),
        weighted("recall").alias("weightedTruePositiveRate"), weighted("fpr").alias("weightedFalsePositiveRate"),
        weighted("f").alias("weightedFMeasure"),
    )


def log_loss(df: DataFrame, probability: str, label: str, eps: float = 1e-15) -> DataFrame:
    p = F.when(F.col(label) > 0, F.col(probability)).otherwise(1.0 - F.col(probability))
    return df.agg(F.avg(-F.log(F.greatest(F.least(p, F.lit(1.0 - eps)), F.lit(eps)))).alias("logLoss"))


def _score_totals(df: DataFrame, score: str, label: str, small: int) -> DataFrame:
    per = df.groupBy(F.col(score).cast("double").alias("value")).agg(
        F.sum(F.when(F.col(label) > 0, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(label) > 0, 0).otherwise(1)).alias("neg"),
    )
    return running_totals(per, "value", ["pos", "neg"], small)


def area_under_roc(df: DataFrame, score: str, label: str, small: int = ONE_TASK_ROWS) -> DataFrame:
    """Share of (positive, negative) pairs in the right order, ties half, from running counts; null with one class."""
    cum = _score_totals(df, score, label, small)
    won = F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") + 0.5 * F.col("neg")))
    return cum.agg(F.try_divide(won, F.sum("pos") * F.sum("neg")).alias("areaUnderROC"))


def area_under_pr(df: DataFrame, score: str, label: str, small: int = ONE_TASK_ROWS) -> DataFrame:
    """Trapezoids between the points of the precision-recall curve, which starts at recall 0;
    null without positives."""
    cum = _score_totals(df, score, label, small)
    all_pos, all_neg = df.agg(F.sum(F.when(F.col(label) > 0, 1).otherwise(0))).scalar(), df.agg(
        F.sum(F.when(F.col(label) > 0, 0).otherwise(1))
    ).scalar()
    # counts at or above a value, and strictly above it
    tp, fp = all_pos - F.col("cum_pos") + F.col("pos"), all_neg - F.col("cum_neg") + F.col("neg")
    tp0, fp0 = tp - F.col("pos"), fp - F.col("neg")
    here = tp / (tp + fp)
    above = F.when(tp0 + fp0 > 0, tp0 / (tp0 + fp0)).otherwise(here)
    return cum.agg(F.try_divide(F.sum(F.col("pos") * (here + above) / 2.0), F.max(all_pos)).alias("areaUnderPR"))


# --- distributions --------------------------------------------------------------------------


def ks_statistic(a: DataFrame, b: DataFrame, name: str = "ks", small: int = ONE_TASK_ROWS) -> DataFrame:
    """Largest gap between the two empirical distribution functions (one column each)."""
    left = a.select(F.col(a.columns[0]).cast("double").alias("value"), F.lit(1).alias("x"), F.lit(0).alias("y"))
    right = b.select(F.col(b.columns[0]).cast("double").alias("value"), F.lit(0).alias("x"), F.lit(1).alias("y"))
    counts = (
        left.unionByName(right).filter(F.col("value").isNotNull()).groupBy("value").agg(F.sum("x").alias("x"), F.sum("y").alias("y"))
    )
    cum = running_totals(counts, "value", ["x", "y"], small)
    gap = F.abs(F.col("cum_x") / counts.agg(F.sum("x")).scalar() - F.col("cum_y") / counts.agg(F.sum("y")).scalar())
    return cum.agg(F.max(gap).alias(name))


def bin_number(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based equal-width bin; the last one includes its right edge."""
    width = (high - low) / bins
    index = F.least(F.floor((value - low) / width), F.lit(bins - 1))
    return F.when((value >= low) & (value <= high), F.when(high > low, index).otherwise(F.lit(0)))


def kl_normalized(predicted: DataFrame, label: DataFrame, name: str = "kl", bins: int = KL_BINS, eps: float = KL_EPSILON) -> DataFrame:
    """1 / (1 + divergence) of binned counts; the bins span the label column."""
    p = predicted.select(F.col(predicted.columns[0]).cast("double").alias("v"), F.lit(0).alias("o"), F.lit(1).alias("e"))
    y = label.select(F.col(label.columns[0]).cast("double").alias("v"), F.lit(1).alias("o"), F.lit(0).alias("e"))
    low, high = y.agg(F.min("v")).scalar(), y.agg(F.max("v")).scalar()
    counts = (
        p.unionByName(y).withColumn("bin", bin_number(F.col("v"), low, high, bins)).filter(F.col("bin").isNotNull())
        .groupBy("bin").agg(F.sum("o").alias("o"), F.sum("e").alias("e"))
    )
    every = counts.sparkSession.range(bins).select(F.col("id").alias("bin")).join(counts, "bin", "left").fillna(0)
    o, e = F.col("o") + eps, F.col("e") + eps
    return every.agg((1.0 / (1.0 + F.sum(o * F.log(o / e) - o + e))).alias(name))


def synthetic_quality(synthetic: DataFrame, real: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: 1 - KS and the normalized KL of synthetic against real values."""
    parts = []
    for c in columns:
        ks = ks_statistic(synthetic.select(c), real.select(c))
        kl = kl_normalized(synthetic.select(c), real.select(c))
        parts.append(
            ks.select(F.lit(c).alias("column"), F.lit("ks").alias("metric"), (1.0 - F.col("ks")).alias("value")).unionByName(
                kl.select(F.lit(c).alias("column"), F.lit("kl").alias("metric"), F.col("kl").alias("value"))
            )
        )
    return reduce(lambda a, b: a.unionByName(b), parts)


REGRESSION = ("rmse", "mse", "r2", "mae", "var")
MULTICLASS = (
    "f1", "accuracy", "weightedPrecision", "weightedRecall", "weightedTruePositiveRate",
    "weightedFalsePositiveRate", "weightedFMeasure", "hammingLoss",
)
BY_LABEL = {
    "truePositiveRateByLabel": "recall", "falsePositiveRateByLabel": "fpr", "precisionByLabel": "precision",
    "recallByLabel": "recall", "fMeasureByLabel": "f",
}
BINARY = {"areaUnderROC": area_under_roc, "areaUnderPR": area_under_pr}


def evaluate(df: DataFrame, names: list[str], prediction: str = "prediction", label: str = "label", threshold: float = 0.5, metric_label: float = 0.0) -> DataFrame:
    """Any of the above by name, in long form (metric, value). An unknown name is an error.

    Class metrics compare the label with ``prediction >= threshold``.
    """
    parts = []
    crisp = df.select(F.when(F.col(prediction) >= threshold, 1.0).otherwise(0.0).alias("p"), F.col(label).cast("double").alias("y"))
    wide = {}
    for name in dict.fromkeys(names):
        if name in REGRESSION:
            wide.setdefault("regression", []).append(name)
        elif name in MULTICLASS:
            wide.setdefault("multiclass", []).append(name)
        elif name in BY_LABEL:
            one = multiclass_metrics(crisp, "p", "y").filter(F.col("label") == metric_label)
            parts.append(one.select(F.lit(name).alias("metric"), F.col(BY_LABEL[name]).alias("value")))
        elif name in BINARY:
            parts.append(BINARY[name](df, prediction, label).select(F.lit(name).alias("metric"), F.col(name).alias("value")))
        elif name == "logLoss":
            parts.append(log_loss(df, prediction, label).select(F.lit(name).alias("metric"), F.col(name).alias("value")))
        elif name == "kstest":
            ks = ks_statistic(df.select(prediction), df.select(label), name)
            parts.append(ks.select(F.lit(name).alias("metric"), F.col(name).alias("value")))
        elif name == "kldiv":
            kl = kl_normalized(df.select(prediction), df.select(label), name)
            parts.append(kl.select(F.lit(name).alias("metric"), F.col(name).alias("value")))
        else:
            raise ValueError(f"unknown metric {name!r}")
    if "regression" in wide:
        table = regression_metrics(df, prediction, label).select(*wide["regression"])
        parts.append(table.unpivot([], wide["regression"], "metric", "value"))
    if "multiclass" in wide:
        table = multiclass_summary(crisp, "p", "y").select(*wide["multiclass"])
        parts.append(table.unpivot([], wide["multiclass"], "metric", "value"))
    if not parts:
        raise ValueError("no metric given")
    return reduce(lambda a, b: a.unionByName(b), parts)
