"""Passages of test items in training texts, found with DataFrame functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shortlist.llm.rows import pack, unpack
from shortlist.session import durable

WINDOW = 10
BROADCAST_WINDOWS = 1_000_000  # more test windows than this are joined by a shuffle

# fixed: a word is a run of ASCII letters, digits and characters beyond ASCII
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GAP_AND_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*" + WORD
GAP_AT_END = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*\z"


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def _words(text: str) -> Column:
    return F.regexp_extract_all(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(WORD), F.lit(0))


def _word_hashes() -> Column:
    # lower() also folds letters beyond ASCII, so equal words stay equal; the join's check is exact
    return F.transform("words", lambda w: F.xxhash64(F.lower(w)))


def _window_hash(at: Column, length: int) -> Column:
    return F.xxhash64(F.slice("hashes", at, F.lit(length)))


def _window_text(at: Column, length: Column) -> Column:
    return _ascii_lower(F.array_join(F.slice("words", at, length), " "))


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(hash, length, passage, item) for every run of ``window`` words of an item; an item of fewer
    words, but not none, is one run."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), _words("text").alias("words"))
    items = items.where(F.size("words") > 0).withColumn("hashes", _word_hashes())
    items = items.withColumn("length", F.least(F.size("words"), F.lit(window)))
    at = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)).alias("at")
    return items.select("item", "words", "hashes", "length", at).select(
        F.xxhash64(F.slice("hashes", F.col("at"), F.col("length"))).alias("hash"), "length",
        _window_text(F.col("at"), F.col("length")).alias("passage"), "item",
    ).distinct()


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with equal doc_id and text are one document; a struct also joins where parts are null."""
    return docs.withColumn("_key", F.struct(F.col("doc_id"), F.xxhash64(F.col("text").cast("string"))))


def occurrences(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(_key, at, length, passage) of every word position of ``docs`` where a test window begins."""
    lengths = [r.length for r in windows.select("length").distinct().collect()]  # at most WINDOW numbers
    passages = windows.select("hash", "length", "passage").distinct()
    if passages.count() <= BROADCAST_WINDOWS:
        passages = F.broadcast(passages)
    scanned = _keyed(docs).select("_key", _words("text").alias("words")).withColumn("hashes", _word_hashes())
    def starts_of(n: int) -> Column:
        # sequence() would count down for a text with fewer words than a window
        places = F.sequence(F.lit(1), F.greatest(F.size("words") - n + 1, F.lit(1)))
        found = F.transform(places, lambda at: F.struct(at.alias("at"), F.lit(n).alias("size"), _window_hash(at, n).alias("hash")))
        return F.when(F.size("words") >= n, found)

    starts = [starts_of(n) for n in sorted(lengths)]
    if not starts:
        return docs.sparkSession.createDataFrame([], "_key struct<doc_id:long,h:long>, at int, length int, passage string")
    empty = F.array().cast("array<struct<at:int,size:int,hash:bigint>>")
    every = F.concat(*[F.coalesce(s, empty) for s in starts])
    # the outer form keeps the arrays from being computed a second time for a size check
    scanned = scanned.select("_key", "words", F.explode_outer(every).alias("w"))
    return (
        scanned.join(passages, (F.col("w.hash") == F.col("hash")) & (F.col("w.size") == F.col("length")))
        .where(_window_text(F.col("w.at"), F.col("length")) == F.col("passage"))
        .select("_key", F.col("w.at").alias("at"), "length", "passage")
    )


def _merged(spans: Column) -> Column:
    """Sorted (at, length) structs -> disjoint (first, last) word positions."""
    empty = F.array().cast("array<struct<first:int,last:int>>")

    def add(done: Column, s: Column) -> Column:
        last = s["at"] + s["length"] - 1
        top = F.element_at(done, -1)
        grown = F.struct(top["first"].alias("first"), F.greatest(top["last"], last).alias("last"))
        return F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["last"] >= s["at"] - 1),
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(grown)),
        ).otherwise(F.concat(done, F.array(F.struct(s["at"].alias("first"), last.alias("last")))))

    return F.aggregate(spans, empty, add)


def _covered(spans: Column) -> Column:
    """Number of word positions in sorted (at, length) structs."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(acc: Column, s: Column) -> Column:
        last = s["at"] + s["length"] - 1
        new = F.greatest(last - F.greatest(acc["end"], s["at"] - 1), F.lit(0))
        return F.struct(F.greatest(acc["end"], last).alias("end"), (acc["n"] + new).alias("n"))

    return F.aggregate(spans, start, add)["n"]


def _spans(hits: DataFrame) -> DataFrame:
    return hits.groupBy("_key").agg(F.array_sort(F.collect_set(F.struct("at", "length"))).alias("spans"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each row of ``docs``.

    Words are runs of ASCII letters, digits and characters beyond ASCII, with A-Z lower-cased. A
    word is hit if it lies in an occurrence of a test window. n_items counts the items with such
    windows, items_sha256 digests their ids, sorted as strings and joined by commas. Null and empty
    texts have no words; an item without words is never found; an item without id has the id ''.
    Repeated rows get the same result. Without test items nothing is hit. Only doc_id and text of
    ``docs``, item_id and text of ``benchmark`` are read.

    Each hit row holds one position; windows that many items share are one row until the items of
    a document are counted.
    """
    windows = durable(item_windows(benchmark, window))
    hits = durable(occurrences(docs, windows))
    spans = _spans(hits).select("_key", _covered(F.col("spans")).alias("n_hit"))
    items = (
        hits.select("_key", "passage").distinct().join(windows.select("passage", "item"), "passage")
        .select("_key", "item").distinct().groupBy("_key")
        .agg(F.count("*").alias("n_items"), F.sha2(F.array_join(F.array_sort(F.collect_list("item")), ","), 256).alias("items_sha256"))
    )
    found = spans.join(items, "_key").withColumnRenamed("_key", "_found")
    n_words = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD)).cast("long")
    rows = _keyed(docs.select("doc_id", "text")).select("_key", "doc_id", n_words.alias("n_words"))
    zero = F.lit(0).cast("long")
    return rows.join(found, F.col("_key") == F.col("_found"), "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"),
    )


def remove_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a test window, all columns."""
    names, packed = docs.columns, pack(docs, "doc_id", "text")
    hits = occurrences(packed, durable(item_windows(benchmark, window))).select(F.col("_key").alias("_found")).distinct()
    kept = _keyed(packed).join(durable(hits).hint("shuffle_hash"), F.col("_key") == F.col("_found"), "left_anti")
    return unpack(kept, names, ("doc_id", "text"))


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the words of test windows, and what stands before each, cut out of ``text``."""
    names, packed = docs.columns, pack(docs, "doc_id", "text")
    hits = occurrences(packed, durable(item_windows(benchmark, window)))
    cuts = durable(_spans(hits).select(F.col("_key").alias("_found"), _merged(F.col("spans")).alias("_cuts")))
    text = F.col("text").cast("string")
    pieces = F.regexp_extract_all(text, F.lit(GAP_AND_WORD), F.lit(0))
    ends = F.concat(F.array(F.lit(0)), F.transform("_cuts", lambda c: c["last"]))
    begins = F.concat(F.transform("_cuts", lambda c: c["first"]), F.array(F.size(pieces) + 1))
    kept = F.zip_with(ends, begins, lambda e, b: F.array_join(F.slice(pieces, e + 1, F.greatest(b - e - 1, F.lit(0))), ""))
    cut = F.concat(F.array_join(kept, ""), F.regexp_extract(text, GAP_AT_END, 0))
    joined = _keyed(packed).join(cuts.hint("shuffle_hash"), F.col("_key") == F.col("_found"), "left")
    reduced = joined.withColumn("text", F.when(F.col("_cuts").isNull(), text).otherwise(cut))
    return unpack(reduced, names, ("doc_id", "text"))
