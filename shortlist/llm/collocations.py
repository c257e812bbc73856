"""Phrase collocations: dynamic itemset counting over shards of the corpus, scored exactly."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shortlist.llm import bloom, words
from shortlist.session import durable, release

MIN_COUNT = 30
MAX_WORDS = 4
TOP = 2000
SHARDS = 4
COVERED_PERCENT = 80
NO_LANG = "und"
NEVER = 255  # a stop that never comes
MOST_CELLS = 1 << 27  # of the table of stops: 128 MB, whatever the input
CELLS_PER_DOCUMENT = 64
CHECK = np.uint64(0xFFFFFFFF)
SUMS = "key long, n long, check long, home long"
FLUSH = 1_000_000  # phrases that a task holds before it sums them up
BATCH = 1 << 18  # sums that leave a task at once; the executor holds a batch outside its heap

WORD = r"[^\x20\x09.,;:!?\x0A-\x0D]+"
BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
IN_WORD = ~BREAK
IN_WORD[[0x20, 0x09]] = False
_STEP, _STEP_TWO, _SEED_TWO = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


class _Text:
    """The words of a chunk of texts, with the hashes of the phrases that begin at each."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, seeds: np.ndarray):
        self.raw = raw
        self.starts, self.ends, bounds = words.word_spans(raw, offsets, IN_WORD)
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
        self.words = words.word_hashes(raw, self.starts, self.ends)
        self.first = words.mix(self.words ^ seeds[self.text])
        self.first_two = words.mix(self.first ^ _SEED_TWO)
        piece = np.cumsum(BREAK[raw])[self.starts] if len(raw) else np.zeros(0, np.int64)
        n = len(self.starts)
        joined = np.zeros(n, bool)  # with the next word, in one piece of one text
        if n:
            joined[:-1] = (np.diff(piece) == 0) & (np.diff(self.text) == 0)
        self.follows = [np.ones(n, bool)]
        for k in range(1, MAX_WORDS):
            longer = np.zeros(n, bool)
            if n > k:
                longer[: n - k] = self.follows[-1][: n - k] & joined[k - 1 : n - 1]
            self.follows.append(longer)

    def longer(self, hashes: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
        """Hashes of the phrases of ``k`` words at the places ``at``, from those of k - 1 words."""
        return words.mix(hashes * _STEP ^ self.words[at + k - 1])

    def longer_two(self, hashes: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
        """The same for a second hash, by which phrases with equal first ones are noticed."""
        return words.mix(hashes * _STEP_TWO ^ self.words[at + k - 1])


def _stops(cells: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The stop at which each phrase was first seen often enough, or an earlier one; NEVER if it was not."""
    if len(hashes) == 0:
        return np.zeros(0, np.uint8)
    return cells[bloom.places_of_ids((hashes >> np.uint64(8)).view(np.int64), len(cells))].max(axis=1)


def _summed(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """(key, n, check, home): occurrences, the sum of their second hashes modulo 2^32, and the first text that has one.
    Empties ``parts``, and joins and orders one column at a time, as a task has little memory beside its executor's heap."""
    keys, two, homes = map(list, zip(*parts))
    parts.clear()
    key = _drained(keys)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    n = np.diff(np.append(first, len(key)))
    key = key[first]
    check = np.add.reduceat(_drained(two)[order], first) & CHECK if len(key) else np.zeros(0, np.uint64)
    home = np.minimum.reduceat(_drained(homes)[order], first) if len(key) else np.zeros(0, np.int64)
    del order, first
    for at in range(0, len(key), BATCH):
        columns = [c[at : at + BATCH] for c in (key.view(np.int64), n, check.view(np.int64), home)]
        yield pa.record_batch([pa.array(c) for c in columns], names=["key", "n", "check", "home"])


def _drained(arrays: list[np.ndarray]) -> np.ndarray:
    out = np.concatenate(arrays)
    arrays.clear()
    return out


def _occurrences(step: int, shards: int, max_words: int, held):
    """Counts of the phrases that are active in a step. A key is 56 bits of the phrase's hash, 6 bits
    of the stop that activated it and 2 of its number of words less one."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.frombuffer(held.value, np.uint8)
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def take(hashes: np.ndarray, two: np.ndarray, homes: np.ndarray, k: int, since: np.ndarray | int) -> None:
            tag = np.uint64(k - 1) | np.left_shift(np.asarray(since).astype(np.uint64), np.uint64(2))
            parts.append((hashes & ~np.uint64(255) | tag, two, homes))

        for batch in batches:
            seeds, ids = _numbers(batch, "_seed").view(np.uint64), _numbers(batch, "_id")
            for first, last, raw, offsets in words.chunks(batch.column("_text")):
                text = _Text(raw, offsets, seeds[first:last])
                homes = ids[first:last][text.text]
                if step < shards:
                    take(text.first, text.first_two, homes, 1, 0)
                if step > 0:
                    hashes, two = text.first.copy(), text.first_two.copy()
                    reached = _stops(cells, hashes)
                    for k in range(2, max_words + 1):
                        at = np.flatnonzero(text.follows[k - 1])
                        since = np.maximum(reached[at], reached[at + 1])
                        hit = since <= step
                        at, since = at[hit], since[hit]
                        hashes[at], two[at] = text.longer(hashes[at], at, k), text.longer_two(two[at], at, k)
                        counting = since > step - shards
                        now = at[counting]
                        take(hashes[now], two[now], homes[now], k, since[counting])
                        reached[:] = NEVER
                        if k < max_words:  # a shared cell must not date a phrase before its own activation
                            reached[at] = np.maximum(_stops(cells, hashes[at]), since)
                if sum(len(p[0]) for p in parts) >= FLUSH:
                    yield from _summed(parts)
        if parts:
            yield from _summed(parts)

    return scan


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _bits(ids: DataFrame, bits: int) -> np.ndarray:
    """Which of ``bits`` places the values of a table's only column, a long, fall on."""
    name = ids.columns[0]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            bloom.put(held, bloom.places_of_ids(batch.column(name).to_numpy(zero_copy_only=False), bits))
        yield from bloom.cut(held, np.zeros_like(held))

    n = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = ids.mapInArrow(build, bloom.PIECES).repartition(n, "piece").sortWithinPartitions("piece").mapInArrow(bloom.merge, bloom.PIECES)
    out = np.zeros(bits // 8, np.uint8)
    for row in pieces.select("piece", "once").collect():
        out[row.piece : row.piece + bloom.PIECE_BYTES] = np.frombuffer(row.once, np.uint8)
    return np.unpackbits(out, bitorder="little").view(bool)


def _frequent(texts: DataFrame, cells: int, min_count: int, max_words: int, shards: int) -> list[DataFrame]:
    """Tables (phrase, n, check, home) of the phrases that were counted ``min_count`` times or more:
    56 bits of the hash, the exact count, and what ``_summed`` says of it.

    Step t scans shard t mod ``shards``; a stop follows every step. Words are counted from the
    start. A longer phrase is counted from the stop on at which both phrases of one word less have
    been seen often enough, and for one full cycle, so each occurrence of an active phrase is counted
    once. Whether and since when a phrase is active follows from the table of stops: cells that
    phrases share with others can only activate too early or too much, alike in every step.
    """
    spark = texts.sparkSession
    stops = np.full(cells, NEVER, np.uint8)
    kept, state, out, latest = None, None, [], 0
    tag = F.col("key").bitwiseAND(F.lit(255))
    since, size = F.shiftright(tag, 2), tag.bitwiseAND(F.lit(3)) + 1
    phrase = F.shiftrightunsigned("key", 8).alias("phrase")
    often = F.col("n") >= min_count
    for step in range(shards * max_words):
        held = spark.sparkContext.broadcast(stops.tobytes())
        scan = _occurrences(step, shards, max_words, held)
        counts = texts.where(F.col("_shard") == step % shards).select("_id", "_seed", "_text").mapInArrow(scan, SUMS)
        counts = counts.withColumn("reached", F.lit(False))
        both = counts if state is None else counts.unionByName(state)
        sums = [F.sum("n").alias("n"), F.sum("check").bitwiseAND(F.lit(int(CHECK))).alias("check"), F.min("home").alias("home")]
        seen = durable(both.groupBy("key").agg(*sums, F.max("reached").alias("reached")))
        held.unpersist()
        if kept is not None:
            release(kept)
        stop = step + 1
        fresh = _bits(seen.where(often & ~F.col("reached") & (size < max_words)).select(phrase), cells) & (stops == NEVER)
        stops[fresh] = stop
        out.append(durable(seen.where(often & (since + shards == stop)).select(phrase, "n", "check", "home")))
        kept, state = seen, seen.where(since + shards > stop).select("key", "n", "check", "home", (F.col("reached") | often).alias("reached"))
        latest = stop if fresh.any() else latest
        if stop == latest + shards:  # whatever was activated last has been through its cycle
            break
    release(kept)
    return out


def _all_hashes(text: _Text, max_words: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(words, places, hashes, second hashes) of the phrases of a chunk, by length."""
    hashes, two, at = text.first.copy(), text.first_two.copy(), np.arange(len(text.starts))
    yield 1, at, hashes[at], two[at]
    for k in range(2, max_words + 1):
        at = np.flatnonzero(text.follows[k - 1])
        hashes[at], two[at] = text.longer(hashes[at], at, k), text.longer_two(two[at], at, k)
        yield k, at, hashes[at], two[at]


def _names(max_words: int):
    """The text of each wanted phrase from its home, and whether its count is of that phrase alone."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds, langs, wanted = _numbers(batch, "_seed").view(np.uint64), batch.column("_lang").to_pylist(), batch.column("_wanted")
            rows: list[tuple[str, int, str, int, int, bool]] = []
            for i in range(batch.num_rows):
                own = wanted[i].values
                ids = own.field("phrase").to_numpy(zero_copy_only=False)
                order = np.argsort(ids)
                ids, n, check = ids[order], *(own.field(c).to_numpy(zero_copy_only=False)[order] for c in ("n", "check"))
                for _, _, raw, offsets in words.chunks(batch.column("_text").slice(i, 1)):
                    text = _Text(raw, offsets, seeds[i : i + 1])
                    body = words.LOWER[raw].tobytes()
                    for k, at, hashes, two in _all_hashes(text, max_words):
                        short = (hashes >> np.uint64(8)).view(np.int64)
                        place = np.minimum(np.searchsorted(ids, short), len(ids) - 1)
                        hit = np.flatnonzero(ids[place] == short)
                        _, one = np.unique(short[hit], return_index=True)
                        one = hit[one]
                        for j, w, g in zip(place[one].tolist(), at[one].tolist(), two[one]):
                            phrase = b" ".join(body[text.starts[w] : text.ends[w + k - 1]].split()) if k > 1 else body[text.starts[w] : text.ends[w]]
                            alone = int(n[j]) * int(g) & int(CHECK) == int(check[j])
                            rows.append((langs[i], k, phrase.decode(), int(n[j]), int(ids[j]), bool(alone)))
            columns = list(zip(*rows)) or [()] * 6
            kinds = (pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.bool_())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=["lang", "words", "phrase", "f", "hash", "alone"])

    return scan


def _held(bits: int, held):
    """Rows whose _id a filter holds."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = np.frombuffer(held.value, np.uint8)
        for batch in batches:
            yield batch.filter(pa.array(bloom.has(ids, bloom.places_of_ids(_numbers(batch, "_id"), bits))))

    return scan


def _recount(bits: int, max_words: int, held):
    """Counts by text of the phrases whose hashes a filter holds: for hashes that several phrases share."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = np.frombuffer(held.value, np.uint8)
        for batch in batches:
            seeds, langs = _numbers(batch, "_seed").view(np.uint64), batch.column("_lang").to_pylist()
            for first, last, raw, offsets in words.chunks(batch.column("_text")):
                text = _Text(raw, offsets, seeds[first:last])
                body = words.LOWER[raw].tobytes()
                counts: dict[tuple[str, int, str], int] = {}
                for k, at, hashes, _ in _all_hashes(text, max_words):
                    for w in at[bloom.has(shared, bloom.places_of_ids((hashes >> np.uint64(8)).view(np.int64), bits))].tolist():
                        phrase = b" ".join(body[text.starts[w] : text.ends[w + k - 1]].split()) if k > 1 else body[text.starts[w] : text.ends[w]]
                        key = langs[first + text.text[w]], k, phrase.decode()
                        counts[key] = counts.get(key, 0) + 1
                langs_, sizes, phrases = zip(*counts) if counts else ((), (), ())
                columns = [pa.array(langs_, pa.string()), pa.array(sizes, pa.int32()), pa.array(phrases, pa.string()), pa.array(counts.values(), pa.int64())]
                yield pa.record_batch(columns, names=["lang", "words", "phrase", "f"])

    return scan


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, shards: int = SHARDS) -> DataFrame:
    """(lang, words, phrase, f): the exact number of occurrences of every phrase of one to
    ``max_words`` words that a language has ``min_count`` times or more, and as the row of no words
    the number of all words of the language.

    The texts are written once, dealt over ``shards``. Dynamic counting finds and counts the phrases
    by hash; a phrase's text is read from the first document that has it, which alone of all texts
    moves. A second hash, summed beside the count, shows where phrases share a hash; those are
    counted again by their text.
    """
    if not 1 <= max_words <= MAX_WORDS or not 1 <= shards * (max_words - 1) < 64:
        raise ValueError("phrases have one to four words, and there are fewer than 64 stops")
    spark = docs.sparkSession
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(lang.alias("_lang"), F.xxhash64(lang).alias("_seed"), text.alias("_text"), F.monotonically_increasing_id().alias("_id"))
    n_words = F.regexp_count("_text", F.lit(WORD)).cast("long").alias("_n")
    texts = durable(rows.select("*", n_words, (F.col("_id") % shards).cast("int").alias("_shard")), "_shard")
    cells = min(MOST_CELLS, bloom.size_for(texts.count(), CELLS_PER_DOCUMENT))
    tables = _frequent(texts, cells, min_count, max_words, shards)
    found = reduce(DataFrame.unionByName, tables)
    homes = durable(found.groupBy(F.col("home").alias("_home")).agg(F.collect_list(F.struct("phrase", "n", "check")).alias("_wanted")))
    bits, filter_ = bloom.of_ids(homes.select("_home"))
    body = texts.select("_id", "_lang", "_seed", "_text")
    body = body.mapInArrow(_held(bits, spark.sparkContext.broadcast(filter_)), body.schema)
    met = body.join(homes.hint("shuffle_hash"), F.col("_id") == F.col("_home")).select("_lang", "_seed", "_text", "_wanted")
    named = durable(met.mapInArrow(_names(max_words), "lang string, words int, phrase string, f long, hash long, alone boolean"))
    counts = named.where("alone").select("lang", "words", "phrase", "f")
    shared = named.where("NOT alone").select("hash")
    if not shared.isEmpty():
        bits, filter_ = bloom.of_ids(shared)
        scan = _recount(bits, max_words, spark.sparkContext.broadcast(filter_))
        again = texts.select("_lang", "_seed", "_text").mapInArrow(scan, "lang string, words int, phrase string, f long")
        again = again.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= min_count)
        counts = counts.unionByName(again.join(counts, ["lang", "words", "phrase"], "left_anti"))
    totals = texts.groupBy(F.col("_lang").alias("lang")).agg(F.sum("_n").alias("f"))
    out = durable(counts.unionByName(totals.select("lang", F.lit(0).alias("words"), F.lit("").alias("phrase"), "f")))
    release(texts, homes, named, *tables)
    return out


def _parts(phrase: Column, size: Column) -> Column:
    """The contiguous phrases of two or more words inside a longer one."""
    tokens = F.split(phrase, " ")
    empty = F.array().cast("array<string>")
    lengths = F.when(size > 2, F.sequence(F.lit(2), size - 1)).otherwise(F.array().cast("array<int>"))
    of = lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.array_join(F.slice(tokens, i, n), " "))
    return F.coalesce(F.array_distinct(F.flatten(F.transform(lengths, of))), empty)


def collocations(
    docs: DataFrame, top: int = TOP, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, shards: int = SHARDS,
    covered_percent: int = COVERED_PERCENT,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of two or more words of each language.

    A-Z are lower-cased; texts are cut at . , ; : ! ? and line ends into pieces, those at blanks and
    tabs into words. a counts the phrase inside pieces, overlaps included. Of the cuts of a phrase
    into a first and a rest, counted l and r times, the one with the lowest floor(2000000 a / (l + r))
    gives the score, the first among equals. A phrase inside a longer frequent one that has at least
    ``covered_percent`` percent of its occurrences is left out. Ties go by a, then by the bytes of the phrase.

    A null lang counts as 'und', a null text as empty; repeated rows count each. Only lang and text
    are read. An empty table, or one without frequent phrases, gives no rows.
    """
    counts = frequent_phrases(docs, min_count, max_words, shards)
    phrases = counts.where("words >= 2").withColumnRenamed("f", "a")
    known = counts.where("words >= 1").select("lang", F.col("phrase").alias("part"), "f")
    cuts = phrases.select("lang", "phrase", "words", "a", F.explode(F.expr("sequence(1, words - 1)")).alias("cut"))
    tokens = F.split("phrase", " ")
    first = F.array_join(F.slice(tokens, F.lit(1), F.col("cut")), " ")
    rest = F.array_join(F.slice(tokens, F.col("cut") + 1, F.col("words")), " ")
    sides = cuts.select("lang", "phrase", "words", "a", "cut", F.explode(F.create_map(F.lit("l"), first, F.lit("r"), rest)).alias("side", "part"))
    cut = sides.join(known, ["lang", "part"]).groupBy("lang", "phrase", "words", "a", "cut").agg(
        *[F.max(F.when(F.col("side") == s, F.col("f"))).alias(s) for s in "lr"]
    )
    wide = "CAST(a AS DECIMAL(20, 0)) * CAST(2000000 AS DECIMAL(7, 0)) div (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))"
    scored = cut.withColumn("score", F.expr(wide)).groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    inside = phrases.where("words > 2").select("lang", F.explode(_parts(F.col("phrase"), F.col("words"))).alias("phrase"), F.col("a").alias("longer"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    hundred = lambda c, by: F.col(c).cast("decimal(20,0)") * F.lit(by).cast("decimal(3,0)")
    covered = F.coalesce(hundred("longer", 100) >= hundred("a", covered_percent), F.lit(False))
    open_ = scored.join(inside, ["lang", "phrase"], "left").where(~covered).select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long")
    totals = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    listed = open_.withColumn("rank", rank).where(F.col("rank") <= top)
    return listed.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
