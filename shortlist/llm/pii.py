"""Personal data: patterns for the entities themselves, corpus statistics for the words that reveal them."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shortlist.llm import words
from shortlist.llm.rows import pack, unpack
from shortlist.session import durable, release

KINDS = ("email", "ip", "card", "phone", "term")  # fixed: the order of kinds at one place
REACH = 5  # words on each side of an entity, on its line, that may reveal it
MIN_DOCS = 2  # documents in which a word must stand beside an entity
DISCLOSURE = 0.75  # share of an entity's information that a word may give away
TERM_BITS = 24
FLUSH = 1 << 21

# A run of digits or of local characters is entered at its first one only, so no text takes more than linear time.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        # what lies before this sign can start no later match: the sign is no local character
        else:
            done = max(done, at + 1)
        at = text.find("@", at + 1)


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the entities, sorted."""
    found = [(s, 0, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def _entity(text: str, start: int, kind: int, end: int) -> str:
    return f"{KINDS[kind]}:{text[start:end].lower()}"


def _near_words(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[str, int, int, int]]:
    """(entity, word hash, start, end) of the words beside each entity on its line, outside all entities."""
    out = []
    taken = [(s, e) for s, _, e in spans]
    for start, kind, end in spans:
        entity = _entity(text, start, kind, end)
        # a bounded piece of the line on each side holds the words that count
        left = max(text.rfind("\n", max(0, start - 400), start) + 1, start - 400, 0)
        stop = text.find("\n", end, end + 400)
        right = min(len(text), end + 400) if stop < 0 else stop
        before = [m.span() for m in _TERM.finditer(text, left, start)][-REACH:]
        after = []
        for m in _TERM.finditer(text, end, right):
            after.append(m.span())
            if len(after) == REACH:
                break
        for s, e in before + after:
            whole = (s == 0 or not _TERM.match(text[s - 1])) and (e == len(text) or not _TERM.match(text[e]))
            if whole and not any(s < y and x < e for x, y in taken):
                out.append((entity, text[s:e], s, e))
    hashes = _hashes([w for _, w, _, _ in out])
    return [(entity, h, s, e) for (entity, _, s, e), h in zip(out, hashes)]


def _hashes(terms: list[str]) -> list[int]:
    if not terms:
        return []
    parts = [t.encode("utf-8", "replace") for t in terms]
    raw = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    return words.word_hashes(raw, ends - [len(p) for p in parts], ends).view(np.int64).tolist()


_FOUND = (
    "doc_id long, text_hash long, counts array<long>, spans array<struct<start:int,kind:int,end:int>>,"
    " entities array<string>, near array<struct<entity:string,term:long,start:int,end:int>>"
)
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
_NEAR = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.int64()), ("start", pa.int32()), ("end", pa.int32())]))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, spans, entities, near = [], [], [], []
        for value in batch.column("text"):
            text = value.as_py() or ""
            own = base_spans(text)
            counts.append([sum(k == kind for _, k, _ in own) for kind in range(4)])
            spans.append([{"start": s, "kind": k, "end": e} for s, k, e in own])
            entities.append(sorted({_entity(text, *x) for x in own}))
            near.append([{"entity": x, "term": t, "start": s, "end": e} for x, t, s, e in _near_words(text, own)])
        yield pa.record_batch(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(counts, pa.list_(pa.int64())), pa.array(spans, _SPANS),
             pa.array(entities, pa.list_(pa.string())), pa.array(near, _NEAR)],
            names=["doc_id", "text_hash", "counts", "spans", "entities", "near"],
        )


def _term_counter(held):
    """Documents that hold each word whose hash is among the wanted ones: (term, docs) in parts."""

    def reduced(parts: list[np.ndarray], sums: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        terms, which = np.unique(np.concatenate(parts), return_inverse=True)
        return terms, np.bincount(which, np.concatenate(sums), len(terms)).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.frombuffer(held.value, np.uint8)
        parts, sums, waiting = [], [], 0
        for batch in batches:
            for _, _, raw, offsets in words.chunks(batch.column("text")):
                starts, ends, bounds = words.word_spans(raw, offsets, words.WORD)
                hashes = words.word_hashes(raw, starts, ends)
                low = hashes & np.uint64((1 << TERM_BITS) - 1)
                hit = np.flatnonzero(wanted[low >> np.uint64(3)] & (np.uint8(1) << (low & np.uint64(7)).astype(np.uint8)))
                text = np.searchsorted(bounds, hit, "right")
                # once for each text: sort by word, then by text
                order = np.lexsort((text, hashes[hit]))
                t, d = hashes[hit][order], text[order]
                first = np.ones(len(t), bool)
                first[1:] = (t[1:] != t[:-1]) | (d[1:] != d[:-1])
                parts.append(t[first])
                sums.append(np.ones(int(first.sum())))
                waiting += len(parts[-1])
                if waiting >= FLUSH:
                    terms, n = reduced(parts, sums)
                    parts, sums, waiting = [terms], [n], len(terms)
                    if waiting >= FLUSH // 2:
                        yield pa.record_batch([pa.array(terms.view(np.int64)), pa.array(n)], names=["term", "docs"])
                        parts, sums, waiting = [], [], 0
        if parts:
            terms, n = reduced(parts, sums)
            yield pa.record_batch([pa.array(terms.view(np.int64)), pa.array(n)], names=["term", "docs"])

    return count


def _bitmap(terms: DataFrame) -> bytes:
    """A map of 2 MB with a bit for the low end of each word's hash."""
    low = F.col("term").bitwiseAND(F.lit((1 << TERM_BITS) - 1))
    rows = (
        terms.select(F.floor(low / 8).cast("int").alias("byte"), F.pow(F.lit(2), low % 8).cast("int").alias("bit"))
        .groupBy("byte").agg(F.bit_or("bit").alias("bits"))
        .groupBy(F.shiftright("byte", 12).alias("page"))
        .agg(F.collect_list(F.struct("byte", "bits")).alias("set"))
    )
    out = np.zeros(1 << (TERM_BITS - 3), np.uint8)
    for row in rows.toLocalIterator():
        for byte, bits in row["set"]:
            out[byte] = bits
    return out.tobytes()


def _texts(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")


def disclosures(docs: DataFrame, found: DataFrame, min_docs: int = MIN_DOCS, threshold: float = DISCLOSURE) -> DataFrame:
    """(entity, term, disclosure): the words that reveal an entity.

    With N documents, n(e) that hold the entity, n(t) that hold the word and n(t, e) where it
    stands beside the entity, the word gives away log(n(t, e) N / n(t) n(e)) of the entity's
    log(N / n(e)) bits. A word is listed if that share reaches ``threshold`` and n(t, e) is at
    least ``min_docs``. All counts are over all documents.
    """
    spark = docs.sparkSession
    beside = found.select("doc_id", "text_hash", F.explode("near").alias("w")).select(
        "doc_id", "text_hash", F.col("w.entity").alias("entity"), F.col("w.term").alias("term")).distinct()
    both = durable(beside.groupBy("entity", "term").agg(F.count("*").alias("both")).where(F.col("both") >= min_docs))
    # also where the entity has no word beside it
    holds = found.select("doc_id", "text_hash", F.explode("entities").alias("entity")).distinct().groupBy("entity").agg(F.count("*").alias("with_entity"))
    wanted = spark.sparkContext.broadcast(_bitmap(both.select("term").distinct()))
    terms = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(
        _term_counter(wanted), "term long, docs long")
    with_term = terms.groupBy("term").agg(F.sum("docs").alias("with_term"))
    n = docs.count()
    share = F.log2(F.col("both") * F.lit(float(n)) / (F.col("with_term") * F.col("with_entity"))) / F.log2(F.lit(float(n)) / F.col("with_entity"))
    # an entity that every document holds has nothing to give away
    rows = both.join(holds, "entity").where(F.col("with_entity") < n).join(with_term, "term")
    return rows.select("entity", "term", share.alias("disclosure")).where(F.col("disclosure") >= threshold)


def personal_data(docs: DataFrame, min_docs: int = MIN_DOCS, threshold: float = DISCLOSURE) -> DataFrame:
    """doc_id, text_hash, counts (of the four kinds), base and spans for each row of ``docs``.

    base holds (start, kind, end) of e-mail addresses, IP addresses, card and phone numbers in code
    points, sorted; spans has these and the words that ``disclosures`` finds beside them. Null and
    empty texts have none. Rows with equal doc_id and text are one document; each gets a row.
    """
    found = durable(_texts(docs).mapInArrow(_find, _FOUND))
    listed = disclosures(docs, found, min_docs, threshold).select("entity", "term")
    one = found.where(F.size("near") > 0).select("doc_id", "text_hash", F.explode("near").alias("w")).select(
        "doc_id", "text_hash", F.col("w.entity").alias("entity"), F.col("w.term").alias("term"), F.col("w.start").alias("start"), F.col("w.end").alias("end"))
    extra = (
        one.join(listed, ["entity", "term"])
        .groupBy(F.struct("doc_id", "text_hash").alias("of"))
        .agg(F.collect_set(F.struct("start", F.lit(len(KINDS) - 1).alias("kind"), "end")).alias("extra"))
    )
    joined = found.join(extra, F.struct("doc_id", "text_hash") == F.col("of"), "left")
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return joined.select(
        "doc_id", "text_hash", "counts", F.col("spans").alias("base"),
        F.array_sort(F.concat("spans", F.coalesce("extra", none))).alias("spans"),
    )


def spans_text(spans: str):
    """kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def sanitise(docs: DataFrame, min_docs: int = MIN_DOCS, threshold: float = DISCLOSURE) -> DataFrame:
    """``docs`` with entities generalised to <KIND> and revealing words removed, other columns kept."""
    spans = personal_data(docs, min_docs, threshold).where(F.size("spans") > 0).select(
        F.struct("doc_id", "text_hash").alias("_of"), F.col("spans").alias("_spans")).dropDuplicates(["_of"])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = pack(docs, "doc_id", "text").withColumn("_key", F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash")))
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS[:-1]], F.lit(""))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def put(acc, s):
        # of overlapping spans the first one is replaced, and the rest of the later one goes with it
        gap = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        mark = F.when(s["start"] >= acc["at"], F.get(names, s["kind"])).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["done"], gap, mark).alias("done"))

    out = F.aggregate("_spans", start, put)
    clean = F.concat(out["done"], F.substring(text, out["at"] + 1, F.char_length(text)))
    joined = keyed.join(spans.hint("shuffle_hash"), F.col("_key") == F.col("_of"), "left")
    reduced = joined.withColumn("text", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(clean))
    return unpack(reduced, docs.columns, ("doc_id", "text"))
