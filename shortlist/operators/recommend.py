"""Recommenders as functions: tables in, per-user lists (user_idx, item_idx, relevance, rank) out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shortlist.functions import vectors
from shortlist.functions.randomness import uniform
from shortlist.operators import popularity as pop
from shortlist.operators.features import standard_scaled
from shortlist.operators.graph import edges, node_ids, propagate, reversed_too, stored_node_ids
from shortlist.operators.profile import category_preferences, user_profiles
from shortlist.operators.sampling import exactly
from shortlist.operators.sequences import Sequences, category_scores
from shortlist.plans.draws import sequential_draws
from shortlist.plans.grouped_topk import grouped_vector_topk
from shortlist.plans.near_tree import near_lists
from shortlist.plans.ordering import global_row_number
from shortlist.plans.skew import lookup
from shortlist.plans.topk import SCORE_DIGITS, drop_seen, prefix_rows, prefix_topk, rounded, topk_per_user
from shortlist.plans.vector_topk import BLOCK_ITEMS, CELL_ITEMS, Cells, vector_topk
from shortlist.session import durable
from shortlist.sources.log import user_log

NGRAM, NGRAM_SMOOTHING = 2, 0.5
SEQUENCE_WEIGHT, CATEGORY_WEIGHT = 0.7, 0.3
PRICE_WEIGHT = 0.3
DISTANCE_EPSILON = 1e-10
LISTED_PER_TASK = 1_000_000  # rows of lists that a task sums and ranks


# --- candidates -----------------------------------------------------------------------------


def random_items(items: DataFrame, k: int, seed) -> DataFrame:
    return exactly(items.select("item_idx"), k, seed, ["item_idx"])


def random_candidates(users: DataFrame, items: DataFrame, k: int, seed) -> DataFrame:
    """Every user with the same k random items. The k items travel as one array literal."""
    chosen = sorted(r[0] for r in random_items(items, k, seed).collect())  # k rows
    arr = F.array(*[F.lit(i) for i in chosen]).cast("array<long>")
    return users.select("user_idx", F.explode(arr).alias("item_idx"))


def user_items_and_log(users: DataFrame, items: DataFrame, log: DataFrame, k: int, seed) -> tuple[DataFrame, DataFrame]:
    return random_candidates(users, items, k, seed), user_log(log, users)


# --- scores that are the same for every user ------------------------------------------------


def popularity(log: DataFrame, users: DataFrame, items: DataFrame, k: int, filter_seen: bool = True, alpha: float = pop.SMOOTHING, depth: int | None = None) -> DataFrame:
    return prefix_topk(users, pop.popularity_table(log, items, alpha), log if filter_seen else None, k, depth)


def ucb(log: DataFrame, users: DataFrame, items: DataFrame, k: int, filter_seen: bool = True, coef: float = pop.EXPLORATION, depth: int | None = None) -> DataFrame:
    return prefix_topk(users, pop.ucb_table(log, items, coef), log if filter_seen else None, k, depth)


def ucb_raw(log: DataFrame, users: DataFrame, items: DataFrame, k: int, coef: float = pop.EXPLORATION) -> DataFrame:
    """The first k + (own history size) items, seen ones included."""
    depths = pop.history_sizes(log, users).select("user_idx", (F.col("items") + k).alias("depth"))
    n_items = items.agg(F.count(F.lit(1))).scalar()
    depths = depths.withColumn("depth", F.least("depth", n_items))
    return prefix_rows(depths, pop.ucb_table(log, items, coef))


def scored_pairs(pairs: DataFrame, log: DataFrame, coef: float = pop.EXPLORATION) -> DataFrame:
    """Confidence-bound scores of given pairs; an item without history gets the fill value."""
    counts = pop.item_counts(log)
    out = lookup(pairs, pop.ucb_scores(counts, coef).select("item_idx", "relevance"), "item_idx", "left")
    return out.withColumn("relevance", F.coalesce("relevance", pop.ucb_fill(counts, coef)))


def ucb_price(log: DataFrame, users: DataFrame, items: DataFrame, k: int, weight: float = PRICE_WEIGHT, filter_seen: bool = True) -> DataFrame:
    """Confidence-bound score plus ``weight`` times the price scaled to 0..1 (our definition)."""
    low, high = items.agg(F.min("price")).scalar(), items.agg(F.max("price")).scalar()
    scaled = F.when(high > low, (F.col("price") - low) / (high - low)).otherwise(0.0)
    scores = pop.ucb_table(log, items).join(items.select("item_idx", "price"), "item_idx")
    scores = scores.select("item_idx", (F.col("relevance") + F.lit(weight) * scaled).alias("relevance"))
    return prefix_topk(users, scores, log if filter_seen else None, k)


def expected_revenue(scored_items: DataFrame, items: DataFrame, users: DataFrame, log: DataFrame | None, k: int) -> DataFrame:
    """Rank by relevance times price; an item without a price counts as 1."""
    out = scored_items.join(items.select("item_idx", "price"), "item_idx", "left")
    out = out.select("item_idx", (F.col("relevance") * F.coalesce("price", F.lit(1.0))).alias("relevance"))
    return prefix_topk(users, out, log, k)


def expected_revenue_pairs(scored: DataFrame, items: DataFrame, log: DataFrame | None, k: int) -> DataFrame:
    """The same for scores given per (user, item) pair, whatever model made them."""
    rows = scored if log is None else drop_seen(scored, log)
    out = lookup(rows.select("user_idx", "item_idx", "relevance"), items.select("item_idx", "price"), "item_idx", "left")
    out = out.withColumn("relevance", F.round(F.col("relevance") * F.coalesce("price", F.lit(1.0)), 9)).drop("price")
    return topk_per_user(out, k)


# --- random lists ---------------------------------------------------------------------------


def random_topk(log: DataFrame | None, users: DataFrame, items: DataFrame, k: int, seed) -> DataFrame:
    """k random unseen items per user, with the k largest of as many uniform scores, descending.

    With n unseen items, the largest of n uniforms is u^(1/n), the next one the largest of n-1
    below it, and so on: the same lists as scoring every pair, without every pair.
    """
    n_items = items.agg(F.count(F.lit(1))).scalar()
    if log is None:
        wanted = users.select("user_idx").withColumn("taken", F.lit(0).cast("long"))
        seen = None
    else:
        seen = durable(log.select("user_idx", "item_idx").join(items.select("item_idx"), "item_idx", "left_semi").distinct())
        wanted = pop.history_sizes(seen, users).withColumnRenamed("items", "taken")
    wanted = wanted.withColumn("free", n_items - F.col("taken"))
    wanted = durable(wanted.withColumn("wanted", F.least(F.lit(k).cast("long"), F.col("free"))))
    drawn = sequential_draws(wanted, items, seed, without=seen)
    steps = wanted.select("user_idx", "free", "wanted", F.explode(F.sequence(F.lit(1).cast("long"), F.col("wanted"))).alias("rank")).filter(
        F.col("rank") <= F.col("wanted")
    )
    log_u = F.log(1.0 - uniform(f"{seed}/score", "user_idx", "rank")) / (F.col("free") - F.col("rank") + 1)
    sums = F.sum(log_u).over(_by_rank())
    scores = steps.select("user_idx", "rank", F.round(F.exp(sums), 9).alias("relevance"))
    out = drawn.select("user_idx", "item_idx", F.col("place").cast("long").alias("rank"))
    # k rows a user on both sides, and the planner counts `scores` as the user rows it grew from
    out = out.join(scores.hint("merge"), ["user_idx", "rank"])
    return out.select("user_idx", "item_idx", "relevance", F.col("rank").cast("int").alias("rank"))


def _by_rank():
    return Window.partitionBy("user_idx").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)  # k rows


def ucb_sampled(log: DataFrame, users: DataFrame, items: DataFrame, k: int, seed, coef: float = pop.EXPLORATION, filter_seen: bool = True) -> DataFrame:
    """Per user a draw without replacement by score share; the relevance is that share.

    A user gets k items more than the history is long (at most all items), a cold one k.
    """
    scores = durable(pop.score_share(durable(pop.ucb_table(log, items, coef))))
    n_items = items.agg(F.count(F.lit(1))).scalar()
    if filter_seen:
        sizes = pop.history_sizes(log, users)
    else:
        sizes = users.select("user_idx").withColumn("items", F.lit(0).cast("long"))
    wanted = sizes.select("user_idx", F.least(F.col("items") + k, n_items).alias("wanted"))
    drawn = sequential_draws(wanted, scores.select("item_idx", F.col("relevance").alias("weight")), seed, weight="weight")
    out = lookup(drawn, scores.select("item_idx", "probability"), "item_idx", dim_rows=items)
    return out.select("user_idx", "item_idx", F.round("probability", 12).alias("relevance"), F.col("place").cast("int").alias("rank"))


# --- personal scores ------------------------------------------------------------------------


def content(log: DataFrame, users: DataFrame, item_vectors: DataFrame, dim: int, k: int, threshold: float = 0.0, seed=0, filter_seen: bool = True, **blocks) -> DataFrame:
    """Cosine between the user's weighted mean vector and each unseen item vector.

    A user without a profile gets random items; a zero profile has similarity 0 to all.
    """
    # the log is read once: only rows of known users and items matter, for profiles and as seen pairs
    pairs = log.select("user_idx", "item_idx", "relevance").join(item_vectors.select("item_idx"), "item_idx", "left_semi")
    pairs = durable(pairs.join(users.select("user_idx"), "user_idx", "left_semi"))
    # read by the search and by the check for cold users
    profiles = durable(user_profiles(pairs, item_vectors, dim))
    queries = profiles.select("user_idx", vectors.normalized("vec").alias("vec"))
    units = item_vectors.select("item_idx", vectors.normalized("vec").alias("vec"))
    seen = pairs.select("user_idx", "item_idx") if filter_seen else None
    known = vector_topk(queries, units, k, "dot", seen, threshold, query_rows=users, **blocks).withColumnRenamed("score", "relevance")
    cold = users.select("user_idx").join(profiles.select("user_idx"), "user_idx", "left_anti")
    if cold.isEmpty():
        return known
    other = random_topk(seen, cold, item_vectors, k, seed).filter(F.col("relevance") >= threshold)
    return known.unionByName(other)


def hybrid(lists: list[DataFrame], items: DataFrame, k: int, weights: list[float] | None = None) -> DataFrame:
    """Weighted sum of the scores of several lists (ask each for 2k items); a missing score is 0."""
    weights = weights or [1.0] * len(lists)
    total = sum(weights)
    rows = None
    for recs, w in zip(lists, weights):
        part = recs.select("user_idx", "item_idx", (F.col("relevance") * (w / total)).alias("relevance"))
        rows = part if rows is None else rows.unionByName(part)
    rows = durable(rows)  # counted, and read for the items listed and for the sums
    # dealt by user once, in parts of bounded size, for the sums and for the ranking
    dealt = rows.repartition(max(1, -(-rows.count() // LISTED_PER_TASK)), "user_idx")
    sums = dealt.groupBy("user_idx", "item_idx").agg(F.round(F.sum("relevance"), 11).alias("relevance"))
    listed = durable(items.join(rows.select("item_idx").distinct(), "item_idx", "left_semi"))  # lists share their heads
    joined = lookup(sums, listed, "item_idx", heavy_in=rows)
    return topk_per_user(joined, k)


def neutral(users: DataFrame, items: DataFrame, log: DataFrame | None, k: int) -> DataFrame:
    """Lists when there is no model at all: every item scores 0.5."""
    return prefix_topk(users, items.select("item_idx", F.lit(pop.NEUTRAL).alias("relevance")), log, k)


def neighbours(
    queries: DataFrame, train: DataFrame, n: int, metric: str = "euclidean", cells: Cells | None = None, keep: tuple[str, ...] = (), unique: bool = False, **blocks
) -> DataFrame:
    """The n nearest training rows (columns row_id, vec) of each query (columns qid, vec), with the training
    rows' columns ``keep``. ``unique`` tells that no two queries have the same qid."""
    cells = cells or neighbour_cells(train, metric, **blocks)
    if cells.tree is None:
        near = vector_topk(queries, train, n, metric, query="qid", item="row_id", cells=cells, **blocks)
        near = near.select("qid", "row_id", (-F.col("score")).alias("distance"), "rank")
        return lookup(near, train.select("row_id", *keep).distinct(), "row_id") if keep else near
    lists = near_lists(queries.select("qid", "vec"), train, n, cells.tree, "qid", "row_id", "vec", SCORE_DIGITS, keep, unique)
    rows = lists.select("qid", F.posexplode("near").alias("_place", "_near"))
    return rows.select(
        "qid", F.col("_near.item").alias("row_id"), (-F.col("_near.score")).alias("distance"), (F.col("_place") + 1).alias("rank"),
        *[F.col(f"_near.{c}").alias(c) for c in keep],
    )


def has_repeats(rows: DataFrame, key: str) -> bool:
    """Whether two rows may have the same key; told by hashes, which are shorter than most keys."""
    return not rows.groupBy(F.xxhash64(key)).count().filter(F.col("count") > 1).isEmpty()


def summed_labels(train: DataFrame, repeats: bool) -> DataFrame:
    """Training rows (row_id, vec, label) with the sum ``_sum`` of the labels and the number ``_same`` of the
    rows that have the same id: what a row adds to a mean of labels."""
    if not repeats:
        return train.withColumns({"_sum": F.col("label").cast("double"), "_same": F.lit(1).cast("long")})
    sums = train.groupBy("row_id").agg(F.sum(F.col("label").cast("double")).alias("_sum"), F.count(F.lit(1)).alias("_same"))
    return durable(train.join(sums.hint("merge"), "row_id"))


def neighbour_mean(near: DataFrame, labels: DataFrame) -> DataFrame:
    """Inverse-distance weighted mean label per query. ``near`` is read more than once."""
    w = 1.0 / (F.col("distance") + DISTANCE_EPSILON)
    joined = lookup(near, labels.select("row_id", "label"), "row_id")
    return joined.groupBy("qid").agg((F.sum(w * F.col("label")) / F.sum(w)).alias("relevance"))


def listed_mean(near: str) -> Column:
    """The same of a list of neighbours that carry ``_sum`` and ``_same``."""
    total = lambda c: F.aggregate(
        F.transform(near, lambda x: F.coalesce(x[c], F.lit(0)) / (DISTANCE_EPSILON - x["score"])), F.lit(0.0), lambda a, b: a + b
    )
    return total("_sum") / total("_same")


def neighbour_cells(train: DataFrame, metric: str = "euclidean", cell_items: int = CELL_ITEMS, block_items: int = BLOCK_ITEMS, **_) -> Cells:
    """The cells of the training rows, for several searches among the same rows."""
    return Cells(train, "row_id", "vec", metric, cell_items, block_items, None, True)


def knn_scores(
    candidates: DataFrame, train: DataFrame, n: int, metric: str = "euclidean", whole: bool = True, cells: Cells | None = None, **blocks
) -> DataFrame:
    """Candidate pairs (user_idx, item_idx, vec) with ``relevance``, the inverse-distance mean label of
    the ``n`` nearest training rows (row_id, vec, label). Equal points of a region are searched once."""
    cells = cells or neighbour_cells(train, metric, **blocks)
    rows = candidates.select("user_idx", "item_idx", "vec", F.monotonically_increasing_id().alias("qid"))
    rows = durable(rows)  # the ids stay as they are
    value = F.rint("relevance") if whole else F.round("relevance", 6)
    if cells.tree is None:
        near = durable(neighbours(rows.select("qid", "vec"), train, n, metric, cells, **blocks))  # one search, read twice
        scored = rows.join(neighbour_mean(near, train), "qid")
    else:
        if "_same" not in train.columns:
            train = summed_labels(train, has_repeats(train, "row_id"))
        lists = near_lists(rows, train, n, cells.tree, "qid", "row_id", "vec", SCORE_DIGITS, ("_sum", "_same"), unique=True)
        scored = lists.withColumn("relevance", listed_mean("near"))
    return scored.select("user_idx", "item_idx", value.alias("relevance"))


def knn(candidates: DataFrame, train: DataFrame, log: DataFrame | None, k: int, n: int, metric: str = "euclidean", whole: bool = True, **blocks) -> DataFrame:
    """Score candidate pairs (user_idx, item_idx, vec) by their n nearest training rows.

    Training rows are (row_id, vec, label). With ``whole`` the score is rounded to a whole number,
    half to even, so ties are common.
    """
    rows = candidates if log is None else drop_seen(candidates, log)
    return topk_per_user(knn_scores(rows, durable(train), n, metric, whole, **blocks), k)


def knn_catalogue(
    users: DataFrame, items: DataFrame, train: DataFrame, log: DataFrame | None, k: int, n: int, metric: str = "euclidean",
    whole: bool = True, first: int | None = None, **blocks,
) -> DataFrame:
    """The k best unseen items of every user out of all items, by their n nearest training rows.

    A pair's point is the user's ``vec`` followed by the item's. A mean of labels is at most the
    largest label, and ties go to the larger item, so items are scored in descending order: who has k
    items with the largest label needs no further ones. Rounds of doubling size, ``first`` items to
    begin with, serve the users who still do, up to the whole catalogue. The lists are those of
    scoring every pair.
    """
    train = durable(train)
    value = F.rint(F.max("label")) if whole else F.round(F.max("label").cast("double"), 6)
    best = train.agg(value).first()[0]
    places = durable(global_row_number(items.select("item_idx", F.col("vec").alias("_ivec")), [F.col("item_idx").desc()], "_place"))
    last = places.count()
    wanting = users.select("user_idx", F.col("vec").alias("_uvec"))
    cells = neighbour_cells(train, metric, **blocks)
    if cells.tree is not None:
        train = summed_labels(train, has_repeats(train, "row_id"))
    rounds, at, size = [], 0, first or 2 * k
    while best is not None and at < last:
        upto = min(at + size, last)
        reach = wanting.select("*", F.explode(F.sequence(F.lit(at + 1).cast("long"), F.lit(upto).cast("long"))).alias("_place"))
        now = places.filter(F.col("_place").between(at + 1, upto))
        pairs = lookup(reach, now, "_place").select("user_idx", "item_idx", F.concat("_uvec", "_ivec").alias("vec"))
        if log is not None:  # only what was seen of this round's items
            pairs = drop_seen(pairs, log.select("user_idx", "item_idx").join(now.select("item_idx"), "item_idx", "left_semi"))
        rounds.append(durable(knn_scores(pairs, train, n, metric, whole, cells=cells, **blocks)))
        scored = reduce(DataFrame.unionByName, rounds)
        served = scored.filter(F.col("relevance") >= best).groupBy("user_idx").count().filter(F.col("count") >= k)
        wanting = durable(wanting.join(served.select("user_idx"), "user_idx", "left_anti"))
        if wanting.isEmpty():
            break
        at, size = upto, 2 * size
    if not rounds:
        return topk_per_user(users.select("user_idx", F.lit(None).cast("long").alias("item_idx"), F.lit(0.0).alias("relevance")).limit(0), k)
    return topk_per_user(scored, k)


def ngram_revenue(log: DataFrame, users: DataFrame, items: DataFrame, k: int, order: list[str], slice_by, n: int = NGRAM, smoothing: float = NGRAM_SMOOTHING, filter_seen: bool = True, use_category: bool = True, sequences: Sequences | None = None) -> DataFrame:
    """price * (0.7 * probability of the next item + 0.3 * preference for its category).

    Apart from items that followed the user's last n items before, the score is an inner product
    of a short user vector and a short item vector, so the best items come from the blocked search.
    Followers of the user's context are scored in a second search within that context only; their
    true score is above their default one (prices are positive), so the better of both is right.
    """
    seq = sequences or Sequences(log, order, slice_by).stored()
    followers = durable(seq.ngrams(n))  # read several times below
    next_counts = followers.groupBy("item_idx").agg(F.sum("n").alias("n"))
    total = next_counts.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    by_context = followers.groupBy("context").agg(F.sum("n").alias("context_total"))
    items = items.select("item_idx", "category", "price")
    seen = None
    if filter_seen:
        seen = durable(log.select("user_idx", "item_idx").join(users.select("user_idx"), "user_idx", "left_semi").distinct())

    kinds = [r[0] for r in items.select("category").distinct().orderBy("category").collect()]  # become vector places
    n_items = items.agg(F.count(F.lit(1))).scalar()
    base = users.select("user_idx")
    if filter_seen:
        in_catalogue = lookup(seen, items.select("item_idx"), "item_idx")
        sizes = in_catalogue.groupBy("user_idx").agg(F.count(F.lit(1)).alias("h"))
        base = base.join(sizes, "user_idx", "left").select("user_idx", (n_items - F.coalesce("h", F.lit(0))).alias("c"))
    else:
        base = base.withColumn("c", n_items)
    known = lookup(seq.last_contexts(n), by_context, "context")
    base = base.join(known, "user_idx", "left")

    s = F.lit(smoothing)
    if use_category:
        prefs = durable(category_preferences(log, items))  # used twice
        liked = category_scores(prefs, smoothing).groupBy("user_idx").pivot("category", kinds).agg(F.max("score"))
        base = base.join(liked, "user_idx", "left").join(other_category_score(prefs, smoothing), "user_idx", "left")
        cat = [CATEGORY_WEIGHT * F.coalesce(f"`{c}`", "other", F.lit(0.5)) for c in kinds]
    else:
        cat = [F.lit(CATEGORY_WEIGHT * 0.5) for _ in kinds]
    base = durable(base)  # one row per user, used by both searches
    in_context = F.col("context_total").isNotNull()
    unknown = F.when(in_context, 0.0).otherwise(SEQUENCE_WEIGHT / (total + s * F.col("c")))
    default = F.when(in_context, SEQUENCE_WEIGHT * s / (F.col("context_total") + s * F.col("c"))).otherwise(0.0)
    queries = base.select("user_idx", F.array(unknown, default, *cat).alias("vec"))
    price = F.col("price")
    onehot = [F.when(F.col("category") == c, price).otherwise(0.0) for c in kinds]
    counted = items.join(next_counts.withColumnRenamed("n", "uni"), "item_idx", "left")
    targets = counted.select("item_idx", F.array(price * (F.coalesce("uni", F.lit(0)) + s), price, *onehot).alias("vec"))
    targets = durable(targets)
    best = vector_topk(queries, targets, k, "dot", seen, query_rows=users)

    in_ctx = base.filter(in_context)
    share = F.lit(SEQUENCE_WEIGHT) / (F.col("context_total") + s * F.col("c"))
    ctx_queries = in_ctx.select("user_idx", F.col("context").alias("group"), F.array(share, *cat).alias("vec"))
    ctx_items = lookup(followers, items, "item_idx").select(
        F.col("context").alias("group"), "item_idx", F.array(price * (F.col("n") + s), *onehot).alias("vec")
    )
    explicit = grouped_vector_topk(ctx_queries, ctx_items, k, seen)
    both = best.select("user_idx", "item_idx", "score").unionByName(explicit.select("user_idx", "item_idx", "score"))
    merged = both.groupBy("user_idx", "item_idx").agg(F.max("score").alias("relevance"))
    return topk_per_user(merged.withColumn("relevance", rounded()), k)


def other_category_score(preferences: DataFrame, smoothing: float) -> DataFrame:
    """Score of a category the user never took."""
    out = preferences.groupBy("user_idx").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
    return out.select("user_idx", (F.lit(smoothing) / (F.col("total") + smoothing * F.col("kinds"))).alias("other"))


def graph_features(users: DataFrame, items: DataFrame, numeric_users: list[str], numeric_items: list[str]) -> tuple[DataFrame, DataFrame]:
    """Standardized numeric columns side by side: user columns first, then item columns, then a constant."""
    u = standard_scaled(users, numeric_users)
    i = standard_scaled(items, numeric_items)
    zero = F.lit(0.0)
    u = u.select("user_idx", *numeric_users, *[zero.alias(c) for c in numeric_items], F.lit(1.0).alias("bias"))
    i = i.select("item_idx", *[zero.alias(c) for c in numeric_users], *numeric_items, F.lit(1.0).alias("bias"))
    return u, i


def graph_nodes(users: DataFrame, items: DataFrame, numeric_users: list[str], numeric_items: list[str], ids=None) -> DataFrame:
    u, i = graph_features(users, items, numeric_users, numeric_items)
    un, it = ids or node_ids(users, items)
    return u.join(un, "user_idx").drop("user_idx").unionByName(i.join(it, "item_idx").drop("item_idx"))


def graph_embeddings(log: DataFrame, users: DataFrame, items: DataFrame, numeric_users: list[str], numeric_items: list[str], hops: int = 2, symmetric: bool = True, ids=None) -> DataFrame:
    ids = ids or stored_node_ids(users, items)
    e = durable(edges(log, users, items, ids))  # read once for the degrees and once per hop
    nodes = graph_nodes(users, items, numeric_users, numeric_items, ids)
    return propagate(nodes, reversed_too(e) if symmetric else e, [*numeric_users, *numeric_items, "bias"], hops)


def graph_revenue(log: DataFrame, users: DataFrame, items: DataFrame, numeric_users: list[str], numeric_items: list[str], k: int, hops: int = 2, filter_seen: bool = True, digits: int = 9) -> DataFrame:
    """Dot product of the propagated user and item features times the item price."""
    un, it = ids = stored_node_ids(users, items)
    emb = graph_embeddings(log, users, items, numeric_users, numeric_items, hops, ids=ids)
    columns = [*numeric_users, *numeric_items, "bias"]
    emb = durable(emb.select("node", F.array(*[F.round(c, 9) for c in columns]).alias("vec")))
    queries = emb.join(un, "node").select("user_idx", "vec")
    priced = emb.join(it, "node").join(items.select("item_idx", "price"), "item_idx")
    targets = durable(priced.select("item_idx", vectors.scaled("vec", F.coalesce("price", F.lit(1.0))).alias("vec")))
    seen = log.select("user_idx", "item_idx") if filter_seen else None
    return vector_topk(queries, targets, k, "dot", seen, digits=digits, query_rows=users).withColumnRenamed("score", "relevance")
