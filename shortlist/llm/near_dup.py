"""Near-duplicate texts: min-hash signatures, a multi-index join of their chunks, exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shortlist.llm import bloom, words
from shortlist.llm.components import components
from shortlist.session import durable, release

CHUNK = 6  # symbols of 16 bits in a chunk, of which one may differ


@dataclass(frozen=True)
class Rule:
    """Texts are linked if 100 * shared >= percent * united, over runs of ``shingle`` words.

    ``miss`` bounds the chance that a pair exactly at the limit shares no key. A signature is cut
    into c chunks of six symbols. By the pigeonhole, two signatures that differ in at most 2c - 1
    symbols have a chunk with at most one error, and the six ways to leave out one symbol of a
    chunk find it. c is the smallest count that keeps the chance below ``miss``; symbols of a pair
    with similarity s agree with probability s.
    """

    shingle: int = 5
    percent: int = 80
    miss: float = 1e-5

    @property
    def chunks(self) -> int:
        s = self.percent / 100
        apart = 1 - s**CHUNK - CHUNK * s ** (CHUNK - 1) * (1 - s)
        return int(np.ceil(np.log(self.miss) / np.log(apart)))

    @property
    def symbols(self) -> int:
        return CHUNK * self.chunks

    @property
    def radius(self) -> int:
        """Most differing symbols of a pair that is worth confirming: what a linked pair exceeds
        with a chance far below ``miss``."""
        p, n = 1 - self.percent / 100, self.symbols
        chance = np.cumsum([_binomial(n, k) * p**k * (1 - p) ** (n - k) for k in range(n + 1)])
        return int(np.searchsorted(chance, 1 - self.miss / 100))


def _binomial(n: int, k: int) -> float:
    return float(np.prod([(n - i) / (k - i) for i in range(k)])) if k else 1.0


def _sets(column: pa.Array, shingle: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each chunk of texts: the sorted distinct run hashes, and where each text's begin."""
    for _, _, raw, offsets in words.chunks(column):
        starts, ends, bounds = words.word_spans(raw, offsets, words.NOT_SPACE)
        runs, edges = words.window_hashes(words.word_hashes(raw, starts, ends), bounds, shingle)
        own = [np.unique(runs[edges[i] : edges[i + 1]]) for i in range(len(edges) - 1)]
        yield np.concatenate(own), np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int64)


def _identity(values: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set: equal for equal sets."""
    out = []
    for salt in (0xA5A5A5A5A5A5A5A5, 0x3C3C3C3C3C3C3C3C):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(words.mix(values ^ np.uint64(salt)), out=total[1:])
        out.append((total[edges[1:]] - total[edges[:-1]]).view(np.int64))
    return out[0], out[1]


def _signer(shingle: int, symbols: int):
    factors = np.random.default_rng(41).integers(1, 1 << 63, symbols, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for values, edges in _sets(batch.column("text"), shingle):
                n = len(edges) - 1
                sizes = np.diff(edges)
                signature = np.zeros((n, symbols), np.uint16)
                full = np.flatnonzero(sizes)
                if len(full):
                    for k, factor in enumerate(factors):
                        least = np.minimum.reduceat(values * factor, edges[:-1][full])
                        signature[full, k] = words.mix(least) & np.uint64(0xFFFF)
                h1, h2 = _identity(values, edges)
                flat = pa.array(signature.view(np.int16).reshape(-1))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * symbols), flat)
                yield pa.record_batch(
                    [batch.column("doc_id").slice(at, n), pa.array(sizes), pa.array(h1), pa.array(h2), lists],
                    names=["doc_id", "n_shingles", "h1", "h2", "signature"],
                )
                at += n

    return sign


def _setter(shingle: int, bits: int, held):
    """Sets of the rows whose doc_id the filter holds; other texts are not looked at."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.frombuffer(held.value, np.uint8)
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column("doc_id")))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(bloom.has(wanted, bloom.places_of_ids(ids, bits))))
            at = 0
            for values, edges in _sets(batch.column("text"), shingle):
                n = len(edges) - 1
                h1, h2 = _identity(values, edges)
                lists = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(values.view(np.int64)))
                yield pa.record_batch(
                    [batch.column("doc_id").slice(at, n), pa.array(h1), pa.array(h2), lists],
                    names=["doc_id", "h1", "h2", "shingles"],
                )
                at += n

    return sets


def signatures(docs: DataFrame, rule: Rule) -> DataFrame:
    """(doc_id, n_shingles, h1, h2, signature) of each row. h1 and h2 are equal for equal sets."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _signer(rule.shingle, rule.symbols),
        "doc_id long, n_shingles long, h1 long, h2 long, signature array<short>",
    )


def index_keys(reps: DataFrame, rule: Rule) -> DataFrame:
    """(rep, key) for every chunk and every symbol that is left out of it."""
    chunks, size = rule.chunks, rule.symbols

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            flat = batch.column("signature").flatten().to_numpy(zero_copy_only=False)
            symbols = flat.astype(np.uint64).reshape(n, size) & np.uint64(0xFFFF)
            out = np.empty((n, chunks * CHUNK), np.uint64)
            for c in range(chunks):
                for left_out in range(CHUNK):
                    key = np.full(n, c * CHUNK + left_out + 1, np.uint64)
                    for k in range(CHUNK):
                        if k != left_out:
                            key = words.mix(key ^ (symbols[:, c * CHUNK + k] + np.uint64(1)) << np.uint64(20))
                    out[:, c * CHUNK + left_out] = key
            reps_of = np.repeat(batch.column("rep").to_numpy(), chunks * CHUNK)
            yield pa.record_batch([pa.array(reps_of), pa.array(out.reshape(-1).view(np.int64))], names=["rep", "key"])

    return reps.select("rep", "signature").mapInArrow(keys, "rep long, key long")


# cheap conditions that every linked pair fulfils, but for a chance far below the rule's ``miss``
def _worth_confirming(rule: Rule):
    return F.expr(
        f"""100 * least(n_shingles_a, n_shingles_b) >= {rule.percent} * greatest(n_shingles_a, n_shingles_b)
        and aggregate(zip_with(signature_a, signature_b, (x, y) -> int(x <> y)), 0, (s, x) -> s + x) <= {rule.radius}"""
    )


def _side(df: DataFrame, side: str, *same: str) -> DataFrame:
    return df.select(*same, *[F.col(c).alias(f"{c}_{side}") for c in df.columns if c not in same])


def _compared(docs: DataFrame, reps: DataFrame, near: DataFrame, rule: Rule) -> DataFrame:
    """Each pair (a, b) of ``near`` with its full sets as set_a and set_b. The texts of all
    documents in a pair are read again; a filter of their ids keeps all others out of the work, and
    no text is shuffled."""
    side = lambda s: near.select(F.col(s).alias("rep"), F.lit(s == "a").alias("as_a"), F.lit(s == "b").alias("as_b"))
    wanted = side("a").unionAll(side("b")).groupBy("rep").agg(F.max("as_a").alias("as_a"), F.max("as_b").alias("as_b"))
    wanted = durable(wanted.join(reps.select("rep", "doc_id", "h1", "h2"), "rep"))
    bits, ids = bloom.of_ids(wanted.select("doc_id"))
    held = docs.sparkSession.sparkContext.broadcast(ids)
    sets = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _setter(rule.shingle, bits, held), "doc_id long, h1 long, h2 long, shingles array<long>")
    # rows of one doc_id with another text are another class; repeated ones give the same set again
    sets = durable(
        sets.join(wanted, ["doc_id", "h1", "h2"])
        .groupBy("rep").agg(F.first("shingles").alias("shingles"), F.max("as_a").alias("as_a"), F.max("as_b").alias("as_b"))
    )
    release(wanted)
    a, b = (sets.where(f"as_{s}").select(F.col("rep").alias(s), F.col("shingles").alias(f"set_{s}")) for s in "ab")
    return near.join(a, "a").join(b, "b")


def _confirmed(docs: DataFrame, reps: DataFrame, near: DataFrame, rule: Rule) -> DataFrame:
    """The pairs of ``near`` that the rule links, decided on their full sets."""
    shared = F.size(F.array_intersect("set_a", "set_b"))
    return durable(
        _compared(docs, reps, near, rule)
        .where(100 * shared >= rule.percent * (F.size("set_a") + F.size("set_b") - shared))
        .select("a", "b")
    )


def _against_heads(docs: DataFrame, reps: DataFrame, stars: DataFrame, rule: Rule) -> DataFrame:
    """Each pair of a text a and a head b with the runs that a lacks and the runs that it adds.

    Two texts u and v of one head of P runs share P - lacks(u) - lacks(v) + o runs, where o counts
    the differences that they have in common. With p percent, they are linked if
    2 (100 + p) o >= need(u) + need(v), where need = (p - 100) P + 200 lacks + 2 p adds. The head
    itself has need (p - 100) P, so a is linked with its head if need <= (100 - p) P.
    """
    p = rule.percent
    return durable(
        _compared(docs, reps, stars, rule)
        .select(
            "a", "b", F.size("set_b").alias("size"),
            F.array_except("set_b", "set_a").alias("lacks"), F.array_except("set_a", "set_b").alias("adds"),
        )
        .withColumn("need", (p - 100) * F.col("size") + 200 * F.size("lacks") + 2 * p * F.size("adds"))
        .withColumn("linked", F.col("need") <= (100 - p) * F.col("size"))
    )


def _links_by_differences(apart: DataFrame, placed: DataFrame, rule: Rule) -> DataFrame:
    """Links between texts of one head that are in different components.

    One of the two is not linked with the head, so it needs common differences: for a pair,
    ceil((need(u) + need(v)) / 2 (100 + p)) of them, at least one. Of each text's differences,
    rarest first, those beyond what the least demanding partner leaves are no join keys; a pair
    that is linked still meets on one of the others. The join's condition is the rule itself, so
    only links leave it.
    """
    p = rule.percent
    members = apart.join(placed, F.col("a") == F.col("node"), "left").select(
        "a", "b", "size", "need", "linked", "lacks", "adds", F.coalesce("component", "a").alias("component"))
    groups = members.groupBy("b").agg(
        F.min("need").alias("least_need"), F.min("component").alias("lo"), F.max("component").alias("hi")
    ).where("lo < hi").select("b", "least_need")
    # what a text lacks and what it adds never coincide
    members = durable(members.join(groups, "b").withColumn("differs", F.concat("lacks", "adds")).drop("lacks", "adds"))
    one = members.select("a", "b", "linked", F.explode("differs").alias("run"))
    # every pair that is looked for has an unlinked text, so other runs can meet nobody
    often = one.groupBy("b", "run").agg(F.count("*").alias("often"), F.count_if(~F.col("linked")).alias("unlinked"))
    often = often.where("often > 1 and unlinked > 0").drop("unlinked")
    ordered = one.join(often, ["b", "run"]).groupBy("a", "b").agg(
        F.array_sort(F.collect_list(F.struct("often", "run"))).alias("common"))
    # a linked text is only compared with unlinked ones, whose need exceeds (100 - p) * size
    partner = F.when(F.col("linked"), (100 - p) * F.col("size") + 1).otherwise(F.col("least_need"))
    least = F.ceil((F.col("need") + partner) / F.lit(2 * (100 + p)))
    # runs that can meet nobody come first in the order and make no key; they never count as common either
    keys = F.size("common") - F.greatest(least, F.lit(1)) + 1
    light = members.select("a", "b", "size", "need", "least_need", "linked", "component")
    keyed = light.join(ordered, ["a", "b"]).where(keys > 0).select(
        "a", "b", "need", "linked", "component", F.transform("common", lambda c: c["run"]).alias("common"),
        F.explode(F.slice("common", F.lit(1), keys.cast("int"))).alias("at"),
    ).withColumn("run", F.col("at.run")).drop("at")
    u, v = _side(keyed, "u", "b", "run"), _side(keyed, "v", "b", "run")
    return (
        u.where("not linked_u").join(v, ["b", "run"])
        .where("component_u <> component_v and (linked_v or a_u > a_v)")
        .where(2 * (100 + p) * F.size(F.array_intersect("common_u", "common_v")) >= F.col("need_u") + F.col("need_v"))
        .select(F.col("a_u").alias("a"), F.col("a_v").alias("b")).distinct()
    )


def near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of ``docs`` (doc_id, text, ...).

    Words are runs of characters other than ASCII white space, with A-Z lower-cased. A text's set
    holds its runs of ``rule.shingle`` words; a shorter text is one run; null and empty texts have
    an empty set and are linked with nothing. Equal sets form a class, so copies are never paired
    with one another. Classes that share an index key are candidates; the first of a key is its
    head. Each class is compared in full with its heads, which joins a group of copies in one step
    however large it is. Then texts of one such head in different components are joined on the
    differences from it that they have in common, and the few texts that were too unlike their head
    to be compared are taken pair by pair across components. component_id is the smallest doc_id
    reached, kept says that it is the row's own. Rows of one doc_id with different texts are in the
    components of their texts; repeated rows each get a row. A row without doc_id has no component
    and is kept. Other columns of ``docs`` are not read.
    """
    signed = durable(signatures(docs, rule))
    some = signed.where("n_shingles > 0 and doc_id is not null")
    reps = some.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")
    )
    reps = durable(reps.withColumn("rep", F.monotonically_increasing_id()))  # classes are numbered as they are stored
    keys = index_keys(reps, rule)
    heads = keys.groupBy("key").agg(F.min("rep").alias("head"), F.max("rep").alias("top")).where("head < top")
    shared = durable(keys.join(heads, "key").select("key", "rep", "head"))
    traits = reps.select("rep", "n_shingles", "signature")

    stars = shared.where("rep <> head").select(F.col("rep").alias("rep_a"), F.col("head").alias("rep_b")).distinct()
    stars = durable(
        stars.join(_side(traits, "a"), "rep_a").join(_side(traits, "b"), "rep_b").where(_worth_confirming(rule))
        .select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))
    )
    apart = _against_heads(docs, reps, stars, rule)
    known = apart.where("linked").select("a", "b")
    placed = durable(components(known))
    links = durable(known.unionAll(_links_by_differences(apart, placed, rule)))

    # texts that were too unlike their key's head to be compared with it: every pair with them
    rows = shared.join(placed, F.col("rep") == F.col("node"), "left").select(
        "key", "rep", "head", F.coalesce("component", "rep").alias("component"))
    mixed = rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    done = stars.select(F.col("a").alias("rep"), F.col("b").alias("head"), F.lit(True).alias("compared"))
    rows = rows.join(mixed.select("key"), "key", "left_semi").join(done, ["rep", "head"], "left").select(
        "key", "rep", "component", F.expr("coalesce(compared, rep = head)").alias("compared"))
    rows = durable(rows.join(traits, "rep"))
    rest = durable(
        _side(rows.where("not compared"), "a", "key").join(_side(rows, "b", "key"), "key")
        .where("component_a <> component_b and (compared_b or rep_a > rep_b)").where(_worth_confirming(rule))
        .select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct()
    )
    final = durable(components(links.unionAll(_confirmed(docs, reps, rest, rule))))
    release(shared, stars, apart, placed, links, rows, rest)

    labelled = reps.join(final, F.col("rep") == F.col("node"), "left").select(
        "h1", "h2", "doc_id", F.coalesce("component", "rep").alias("component"))
    least = labelled.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    labelled = labelled.select("h1", "h2", "component").join(least, "component").select("h1", "h2", "component_id")
    alone = signed.where("n_shingles = 0 or doc_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    result = some.join(labelled, ["h1", "h2"]).select("doc_id", "n_shingles", "component_id").unionAll(alone)
    return result.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one_of_each(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The rows of ``docs`` whose text is the first of its near-duplicate group, all columns."""
    kept = near_duplicates(docs, rule).where("kept").select("doc_id")
    return docs.join(kept.distinct().hint("shuffle_hash"), docs["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi")
