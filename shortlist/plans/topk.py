"""Per-user top-k lists without building every (user, item) pair."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shortlist.plans.ordering import global_row_number
from shortlist.plans.skew import lookup
from shortlist.session import durable

SCORE_DIGITS = 9
RANGE = 65_536  # ranks per block in the fallback of prefix_topk
PREFIX_SALT = 32
USERS_PER_TASK = 100_000  # each becomes a list


def rounded(column: str = "relevance", digits: int = SCORE_DIGITS):
    """Scores are rounded before ranking: sums of doubles differ in the last bits."""
    return F.round(F.col(column), digits)


def best_first(score: str = "relevance", item: str = "item_idx"):
    """The order used everywhere: score descending, ties by item descending."""
    return [F.col(score).desc(), F.col(item).desc()]


def topk_per_user(df: DataFrame, k: int, user: str = "user_idx", order=None, rank: str = "rank") -> DataFrame:
    """Keep the first k rows of each user; Spark limits each group before the shuffle."""
    w = Window.partitionBy(user).orderBy(*(order or best_first()))
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def drop_seen(pairs: DataFrame, log: DataFrame) -> DataFrame:
    """Remove pairs already in the log; both keys are hashed, so a hot user or item is spread."""
    return pairs.join(log.select("user_idx", "item_idx"), ["user_idx", "item_idx"], "left_anti")


def dealt_users(users: DataFrame, per_task: int = USERS_PER_TASK) -> DataFrame:
    """The users' keys in tasks of at most about ``per_task``. Files of keys are small, so as they are read a few tasks
    hold all users, each of whom grows into a list."""
    users = users.select("user_idx")
    tasks = max(users.sparkSession.sparkContext.defaultParallelism, -(-users.count() // per_task))
    return users.repartition(tasks, "user_idx")


def prefix_topk(
    users: DataFrame, scored_items: DataFrame, log: DataFrame | None, k: int, depth: int | None = None
) -> DataFrame:
    """Top-k unseen items per user when the score does not depend on the user.

    Only the best ``depth`` items can matter for a user who has not seen more than ``depth - k`` of
    them. Those items are few and bounded, so the log is filtered against them where it lies and
    each user keeps at most ``depth`` seen ranks. Users who have seen more go through
    :func:`_deep_topk`, which has no bound.
    """
    depth = max(k, depth or max(8 * k, 256))  # a user without history must be served from the head
    scored = scored_items.select("item_idx", rounded().alias("relevance"))
    # at most `depth` rows: small enough to keep as a local table, so later jobs do not rank again
    best = [tuple(r) for r in scored.orderBy(*best_first()).limit(depth).collect()]
    found = len(best)
    places = [(i + 1, item, score) for i, (item, score) in enumerate(best)]
    head = users.sparkSession.createDataFrame(places, "_place int, item_idx long, relevance double")
    head = F.broadcast(head)
    users = dealt_users(users)
    if log is None:
        out = users.withColumn("_place", F.explode(F.sequence(F.lit(1), F.lit(min(k, found)))))
        return out.join(head, "_place").select("user_idx", "item_idx", "relevance", F.col("_place").alias("rank"))
    seen = (
        log.select("user_idx", "item_idx")
        .join(head.select("item_idx", "_place"), "item_idx")
        .groupBy("user_idx")
        .agg(F.collect_set("_place").alias("_seen"))  # at most `depth` values
    )
    seen = durable(seen)  # small, and read twice: the log is not
    full = found < depth  # the whole catalogue is in the head
    deep_users = None
    if not full:
        deep_users = seen.filter(F.size("_seen") > depth - k).select("user_idx").join(users, "user_idx", "left_semi")
        if deep_users.isEmpty():
            deep_users = None
    every = F.sequence(F.lit(1), F.lit(found)) if found else F.array().cast("array<int>")
    free = F.slice(F.array_except(every, F.coalesce("_seen", F.array().cast("array<int>"))), 1, k)
    shallow = users.join(seen, "user_idx", "left")
    if deep_users is not None:
        shallow = shallow.filter(F.coalesce(F.size("_seen"), F.lit(0)) <= depth - k)
    out = (
        shallow.select("user_idx", F.posexplode(free).alias("rank", "_place"))
        .join(head, "_place")
        .select("user_idx", "item_idx", "relevance", (F.col("rank") + 1).alias("rank"))
    )
    if deep_users is None:
        return out
    return out.unionByName(_deep_topk(deep_users, scored, log, k))


def _deep_topk(users: DataFrame, scored: DataFrame, log: DataFrame, k: int, block: int = RANGE) -> DataFrame:
    """Exact top-k for users who have seen nearly all of the best items.

    Ranks are cut into blocks. A block with fewer seen items than its size has free ranks, and at
    most k such blocks are opened per user, so the work per user is bounded by k blocks.
    """
    ranked = global_row_number(scored, best_first(), "_place")
    ranked = ranked.withColumn("_block", F.floor((F.col("_place") - 1) / block))
    sizes = ranked.groupBy("_block").agg(F.count(F.lit(1)).alias("_size"))
    # the pair is hashed by both columns: one hot user is spread over all tasks
    seen = log.select("user_idx", "item_idx").join(users, "user_idx", "left_semi").distinct()
    seen = lookup(seen, ranked.select("item_idx", "_place", "_block"), "item_idx")
    used = seen.groupBy("user_idx", "_block").agg(F.count(F.lit(1)).alias("_used"))
    grid = users.withColumn("_last", F.lit(sizes.agg(F.max("_block")).scalar()))
    grid = grid.select("user_idx", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last"))).alias("_block"))
    free = (
        grid.join(sizes, "_block")
        .join(used, ["user_idx", "_block"], "left")
        .withColumn("_free", F.col("_size") - F.coalesce("_used", F.lit(0)))
        .filter(F.col("_free") > 0)
    )
    earlier = Window.partitionBy("user_idx").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    opened = free.withColumn("_before", F.coalesce(F.sum("_free").over(earlier), F.lit(0))).filter(F.col("_before") < k)
    candidates = opened.select("user_idx", "_block").join(ranked, "_block")
    left = candidates.join(seen.select("user_idx", "item_idx"), ["user_idx", "item_idx"], "left_anti")
    return topk_per_user(left.select("user_idx", "item_idx", "relevance"), k)


def prefix_rows(depths: DataFrame, scored_items: DataFrame) -> DataFrame:
    """The first ``depth`` items of the global order for each user (columns user_idx, depth)."""
    scored = scored_items.select("item_idx", rounded().alias("relevance"))
    return ranked_prefix(depths, global_row_number(scored, best_first(), "rank"))


def ranked_prefix(depths: DataFrame, ranked: DataFrame, by: list[str] | None = None, block: int = 64) -> DataFrame:
    """The first ``depth`` rows of ``ranked`` (item_idx, relevance, rank) for each user.

    With ``by``, users and ranked rows carry a class, and a user reads the list of the own class.
    Ranks are grouped into small blocks; the first blocks are wanted by every user, so both sides
    carry a salt.
    """
    by = by or []
    blocks = (
        ranked.groupBy(*by, F.floor((F.col("rank") - 1) / block).alias("_block"))
        .agg(F.collect_list(F.struct("rank", "item_idx", "relevance")).alias("_rows"))  # `block` rows each
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(PREFIX_SALT - 1))))
    )
    last = F.floor((F.col("depth") - 1) / block)
    wide = 4_096  # a user with a long history is first cut into ranges of blocks
    wanted = (
        depths.filter(F.col("depth") > 0)
        .select("user_idx", "depth", *by, F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / wide))).alias("_range"))
        .select(
            "user_idx", "depth", *by,
            F.explode(F.sequence(F.col("_range") * wide, F.least(last, (F.col("_range") + 1) * wide - 1))).alias("_block"),
        )
        .withColumn("_salt", F.pmod(F.xxhash64("user_idx"), F.lit(PREFIX_SALT)).cast("int"))
    )
    rows = wanted.join(blocks, [*by, "_block", "_salt"]).select("user_idx", "depth", F.explode("_rows").alias("r"))
    return rows.filter(F.col("r.rank") <= F.col("depth")).select("user_idx", "r.item_idx", "r.relevance", "r.rank")
