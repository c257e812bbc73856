"""Items that can be in some top-k when the score grows with both of two numbers."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shortlist.plans.topk import topk_per_user
from shortlist.session import durable, release

BINS = 256


def undominated(items: DataFrame, x: str, y: str, k: int, bins: int = BINS) -> DataFrame:
    """Drop items that at least k others beat strictly in both ``x`` and ``y``.

    ``x`` is cut into bins. Per bin only the k largest ``y`` are read on the driver; from them
    follows, for each bin, the k-th largest ``y`` in all higher bins. A few items too many may
    stay, none is lost.
    """
    edges = sorted(set(items.approxQuantile(x, [i / bins for i in range(1, bins)], 0.25 / bins)))
    if not edges:
        return items
    # number of edges <= x: items of a higher bin have a strictly larger x
    bin_of = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e <= F.col(x)))
    binned = items.withColumn("_bin", bin_of)
    best = topk_per_user(binned.select("_bin", y), k, "_bin", [F.col(y).desc()]).select("_bin", y).collect()
    per_bin: dict[int, list[float]] = {}
    for b, value in best:
        per_bin.setdefault(b, []).append(value)
    top: list[float] = []
    bars = {}
    for b in sorted(per_bin, reverse=True):
        bars[b] = top[0] if len(top) == k else float("-inf")
        for value in per_bin[b]:
            heapq.heappush(top, value) if len(top) < k else heapq.heappushpop(top, value)
    bar = F.element_at(F.array(*[F.lit(bars.get(b, float("-inf"))) for b in range(len(edges) + 1)]), F.col("_bin") + 1)
    return binned.filter(F.col(y) >= bar).drop("_bin")


def contenders(items: DataFrame, x: str, y: str, k: int, item: str = "item_idx", bins: int = BINS) -> DataFrame:
    """Items that can be among the k best when equal scores go to the larger ``item``.

    Of items with one ``x`` only the k best by ``y`` can. Of the rest, :func:`undominated` always
    keeps the whole highest bin, a fixed share of the items, so it is repeated on what it leaves
    until that hardly shrinks.
    """
    first = topk_per_user(items.filter(F.col(x).isNotNull()), k, x, [F.col(y).desc(), F.col(item).desc()])
    left = durable(first.drop("rank"))
    n = left.count()
    while n > k:
        fewer = durable(undominated(left, x, y, k, bins))
        release(left)
        left, before, n = fewer, n, fewer.count()
        if 2 * n > before:
            break
    return left
