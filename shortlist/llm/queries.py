"""The registered queries of this subpackage, and their SQL where SQL can state the result."""

from __future__ import annotations

import os
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shortlist.llm import (
    block_topk,
    chat,
    collocations,
    decontaminate,
    histogram_shards,
    licenses,
    line_dedup,
    near_dup,
    periodic_runs,
    pii,
    quality,
    sentencepiece_codec,
    span_dedup,
)

#: a public model of the library; the path is a parameter of the operators
PIECE_MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op1_sentencepiece")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ids of every text, and whether their decoding gives the text again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    coded = sentencepiece_codec.decode(sentencepiece_codec.encode(docs, PIECE_MODEL), PIECE_MODEL)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", (F.col("decoded") == F.col("text")).alias("round_trip"))


@query("op2_quality")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# the steps of a text's normal form, see licenses.marked: pattern, replacement
_LICENSE_FORM = [
    (r"\n[^a-z0-9\n]*\n[^a-z0-9]*", "\x02"), (r"\n[^a-z0-9\n]*(?:(?:rem|dnl)[ \t]+)?", "\n"), (r"[.!?;:][ \t\r\n][^a-z0-9\x02]*", "\x01"),
    (r"[^a-z0-9\n\x01\x02]+", " "), (r"[ \n\x01]+([\x01\x02])", r"\1"), (r" \n", "\n"),
]


def _license_sql() -> str:
    known, form = [], "lower(chr(10) || coalesce(text, '') || chr(10))"
    for name, sentence in licenses.SENTENCES.items():
        normal = f"\n{sentence}\n".lower()
        for pattern, new in _LICENSE_FORM:
            normal = re.sub(pattern, new, normal)
        known.append(f"('{name}', '{normal.replace(chr(10), ' ').strip(chr(1) + chr(2) + ' ')}')")
    for pattern, new in _LICENSE_FORM:
        form = f"regexp_replace({form}, '{pattern}', '{new}', 'g')"
    line, names = "l.line", []
    for name, ids in sorted(licenses.RULES, key=lambda r: (-len(r[1]), r[0], r[1])):
        run = f"' {' '.join(ids)} '"
        names.append(f"CASE WHEN contains({line}, {run}) THEN '{name}' END")
        line = f"replace({line}, {run}, ' | ')"
    edge = f"IN ('', '\n', '{chr(1)}', '{chr(2)}')"
    return f"""WITH known(sentence_id, normal) AS (VALUES {', '.join(known)}),
        forms AS (SELECT doc_id, hash(text) AS th, {form} AS form FROM documents GROUP BY ALL),
        parts AS (SELECT doc_id, th, form, sentence_id, normal, string_split(translate(form, '\n', ' '), normal) AS p
                  FROM forms JOIN known ON contains(translate(form, '\n', ' '), normal)),
        places AS (SELECT doc_id, th, form, sentence_id, length(normal) AS size, unnest(list_transform(range(1, len(p)),
                     lambda i: 1 + (i - 1) * length(normal) + list_sum(list_transform(p[1:i], lambda x: length(x)))))::BIGINT AS s FROM parts),
        hits AS (SELECT DISTINCT doc_id, th, sentence_id, s, s + size AS e FROM places
                 WHERE CASE WHEN s > 1 THEN substr(form, s - 1, 1) ELSE '' END {edge} AND substr(form, s + size, 1) {edge}),
        found AS (SELECT * FROM hits h WHERE NOT EXISTS (
                    SELECT 1 FROM hits g WHERE g.doc_id IS NOT DISTINCT FROM h.doc_id AND g.th IS NOT DISTINCT FROM h.th AND g.e >= h.e AND (g.s < h.s OR g.s = h.s AND g.e > h.e))),
        l AS (SELECT doc_id, th, count(*) AS n, string_agg(sentence_id, ',' ORDER BY s, sentence_id) AS ids,
                     ' ' || string_agg(sentence_id, ' ' ORDER BY s, sentence_id) || ' ' AS line FROM found GROUP BY ALL)
        SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_sentences, coalesce(ids, '') AS sentence_ids,
               coalesce(array_to_string(list_sort(list_distinct(list_filter([{', '.join(names)}], lambda x: x IS NOT NULL))), ','), '') AS licenses
        FROM documents d LEFT JOIN l ON l.doc_id IS NOT DISTINCT FROM d.doc_id AND l.th IS NOT DISTINCT FROM hash(d.text)"""


@query("op3_licenses", _license_sql())
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


@query(
    "op4_near_duplicates",
    f"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        runs AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 3) - 1], ' ') AS s
                 FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 3) + 2)) AS i FROM d WHERE len(w) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM runs GROUP BY doc_id),
        pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM runs a JOIN runs b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
        ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reached AS (SELECT doc_id, doc_id AS r FROM d UNION SELECT doc_id, b FROM reached JOIN ways ON r = a)
        SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(r) AS component_id, min(r) = doc_id AS kept
        FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id, n""",
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), near_dup.Rule(shingle=3, percent=85))


@query(
    "op5_block_topk",
    """WITH v AS (
          SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
              FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0)
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20""",
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = block_topk.quantised(table(spark, sf_dir, "embeddings"))
    return block_topk.top_products(vectors, vectors.where("vec_id % 20 = 0"), 20)


@query("op6_personal_data")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    counts = [F.col("counts")[i].alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS[:4])]
    return found.select("doc_id", *counts, F.sha2(pii.spans_text("base"), 256).alias("base_sha256"), pii.spans_text("spans").alias("spans"))


@query("op7_span_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = span_dedup.drop_repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_sentences", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query(
    "op8_perspectives",
    """WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS speaker, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
        p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, text) - 1 AS n FROM t),
        s AS (SELECT DISTINCT conv_id, speaker AS who FROM t),
        r AS (SELECT conv_id, who, (n // 64)::INTEGER AS part, n, speaker = who AS own, text || '<|im_end|>' || chr(10) AS body,
                     CASE WHEN speaker = who THEN '<|im_start|>assistant' || chr(10)
                          ELSE '<|im_start|>user name=' || regexp_replace(speaker, '\\s+', '_', 'g') || chr(10) END AS head
              FROM p JOIN s USING (conv_id)),
        o AS (SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, who, part ORDER BY n)::BIGINT AS stop FROM r)
        SELECT conv_id, who AS speaker, part, count(*)::BIGINT AS n_turns, count(*) FILTER (own)::BIGINT AS n_own,
               string_agg(head || body, '' ORDER BY n) AS text,
               coalesce(string_agg((stop - length(body)) || ':' || stop, ',' ORDER BY n) FILTER (own), '') AS masks
        FROM o GROUP BY conv_id, who, part""",
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rendered = chat.perspectives(table(spark, sf_dir, "conversations"))
    masks = F.array_join(F.transform("masks", lambda m: F.concat_ws(":", m["start"], m["end"])), ",")
    return rendered.withColumn("masks", masks)


@query(
    "op9_line_dedup",
    f"""WITH lines AS (
          SELECT doc_id, i, string_split(coalesce(text, ''), chr(10))[i] AS line
          FROM (SELECT doc_id, text, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i FROM documents)),
        keyed AS (SELECT *, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS k FROM lines),
        repeated AS (SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5)
        SELECT doc_id, count(*)::BIGINT AS n_lines, count(last) FILTER (doc_id <> last)::BIGINT AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (last IS NULL OR doc_id = last), '')) AS kept_sha256
        FROM keyed LEFT JOIN repeated USING (k) GROUP BY doc_id""",
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_lines", "n_dropped", digest)


_WORDS = "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op10_decontaminate",
    f"""WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        windows AS (
          SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS p
          FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)),
        docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        starts AS (
          SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS p
          FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i
                FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
        hits AS (SELECT doc_id, i, n, item_id FROM starts JOIN windows USING (n, p)),
        words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY doc_id),
        found AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(x, ',' ORDER BY x)) AS h
                  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hits) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               coalesce(h, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)""",
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_RUN_CRC = """bits(doc_id, s, pos, step, crc) AS (
          SELECT doc_id, doc_id::VARCHAR, 1, 0, 4294967295::BIGINT FROM documents WHERE doc_id IS NOT NULL
          UNION ALL
          SELECT doc_id, s, pos + (step = 8)::INTEGER, CASE WHEN step = 8 THEN 0 ELSE step + 1 END,
                 CASE WHEN step = 0 THEN xor(crc, ascii(substr(s, pos, 1))::BIGINT)
                      WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384::BIGINT) ELSE crc // 2 END
          FROM bits WHERE pos <= length(s)),
        hashed AS (SELECT doc_id, xor(crc, 4294967295::BIGINT) AS h FROM bits WHERE pos > length(s))"""


@query(
    "op12_periodic_runs",
    f"""WITH RECURSIVE {_RUN_CRC},
        split AS (SELECT DISTINCT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        sized AS (SELECT doc_id, w, len(w) AS n, h, h // 10 AS g FROM split JOIN hashed USING (doc_id)),
        cut AS (SELECT doc_id, w, n, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a, g FROM sized),
        placed AS (SELECT doc_id, n, i, w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END] AS word
                   FROM (SELECT *, unnest(range(0, n)) AS i FROM cut)),
        same AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM placed x JOIN placed y
                 ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
        stretch AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS len FROM (
                      SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same) GROUP BY doc_id, q, island),
        wide AS (SELECT * FROM stretch WHERE len >= greatest(6, 4 * q)),
        runs AS (SELECT * FROM wide r WHERE NOT EXISTS (
                   SELECT 1 FROM wide p WHERE p.doc_id = r.doc_id AND p.q < r.q AND p.s <= r.s AND p.s + p.len >= r.s + r.len)),
        best AS (SELECT doc_id, s, len, q FROM (
                   SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY len::DOUBLE / q DESC, s, q) AS r FROM runs) WHERE r = 1),
        digest AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS t FROM runs GROUP BY doc_id),
        gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM runs),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM placed ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS start, len::BIGINT AS length, q::BIGINT AS period,
               (1000 * len // q)::BIGINT AS exponent_milli, sha256(coalesce(g.t, '')) AS runs_sha256, sha256(coalesce(k.t, '')) AS collapsed_sha256
        FROM documents d LEFT JOIN best USING (doc_id) LEFT JOIN digest g USING (doc_id) LEFT JOIN kept k USING (doc_id)""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.periodic_runs(periodic_runs.with_looping_tails(docs)).drop("text")
    # greatest length / period, compared as products of whole numbers
    ahead = lambda a, b: (b["period"] * a["length"] > a["period"] * b["length"])
    best = F.aggregate(F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))), F.try_element_at("runs", F.lit(1)), lambda top, r: F.when(ahead(r, top), r).otherwise(top))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select("*", best.alias("best")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


# crc32 is linear: every byte adds what its bits have become after the bytes that follow it, first within
# 256 bytes counted from the end, then in steps of 256; the starting value is one more such term
_TEXT_CRC = """steps(v, step, c) AS (
          SELECT i, 0, i::BIGINT FROM range(256) r(i)
          UNION ALL SELECT v, step + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::BIGINT) ELSE c // 2 END FROM steps WHERE step < 8),
        lut AS (SELECT list(c ORDER BY v) AS t FROM steps WHERE step = 8),
        near(k, s) AS (
          SELECT 0, list_append(list_transform(range(32), lambda i: 1::BIGINT << i), 4294967295)
          UNION ALL SELECT k + 1, list_transform(s, lambda x: xor(x // 256, t[1 + x % 256])) FROM near, lut WHERE k < 256),
        jump AS (SELECT s AS m FROM near WHERE k = 256),
        far(j, s) AS (
          SELECT 0, list_transform(range(32), lambda i: 1::BIGINT << i)
          UNION ALL
          SELECT j + 1, list_transform(s, lambda v: list_reduce(list_transform(range(32), lambda i: (v >> i & 1) * m[i + 1]), lambda x, y: xor(x, y)))
          FROM far, jump WHERE j < (SELECT max(strlen(text)) // 256 + 1 FROM documents)),
        codes AS (SELECT printf('%02X', i) AS x, i AS b FROM range(256) r(i)),
        pairs AS (SELECT DISTINCT doc_id, strlen(coalesce(text, '')) AS n, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS p FROM documents),
        each AS (SELECT doc_id, n, unnest(p) AS x, generate_subscripts(p, 1) AS i FROM pairs),
        terms AS (
          SELECT doc_id, (n - i) // 256 AS j, bit_xor(xor(xor(xor((b & 1) * s[1], (b >> 1 & 1) * s[2]), xor((b >> 2 & 1) * s[3], (b >> 3 & 1) * s[4])),
                   xor(xor((b >> 4 & 1) * s[5], (b >> 5 & 1) * s[6]), xor((b >> 6 & 1) * s[7], (b >> 7 & 1) * s[8])))) AS v
          FROM each JOIN codes USING (x) JOIN near ON k = (n - i) % 256 + 1 GROUP BY ALL
          UNION ALL SELECT doc_id, n // 256, s[33] FROM pairs JOIN near ON k = n % 256),
        crc AS (SELECT doc_id, xor(bit_xor(list_reduce(list_transform(range(32), lambda i: (v >> i & 1) * s[i + 1]), lambda x, y: xor(x, y))), 4294967295::BIGINT) AS text_crc32
                FROM terms JOIN far USING (j) GROUP BY doc_id)"""


@query(
    "op13_shards",
    f"""WITH RECURSIVE {_TEXT_CRC},
        d AS (SELECT doc_id, md5(coalesce(text, '')) AS k, strlen(coalesce(text, '')) + 1 AS size FROM documents),
        o AS (SELECT *, coalesce(sum(size) OVER (ORDER BY k, doc_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
                     sum(size) OVER () AS total FROM d),
        p AS (SELECT *, (16 * before // total)::INTEGER AS shard FROM o)
        SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
               (row_number() OVER (PARTITION BY shard ORDER BY k, doc_id NULLS FIRST) - 1)::BIGINT AS slot, NULL::INTEGER AS grown_shard
        FROM p JOIN crc USING (doc_id)""",
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of near equal bytes; the law does not foresee a further shard, so ``grown_shard`` is null."""
    out = histogram_shards.shard(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", histogram_shards.size_of(F.col("text")).alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query(
    "op11_collocations",
    f"""WITH d AS (SELECT coalesce(lang, 'und') AS lang, {_LOWER.format("coalesce(text, '')")} AS t FROM documents),
        pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d),
        w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
        sized AS (SELECT lang, w, unnest([1, 2, 3, 4]) AS k FROM w),
        grams AS (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM sized WHERE len(w) >= k),
        f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL),
        n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
        c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= 30),
        cut AS (SELECT *, unnest(range(1, k)) AS j FROM c),
        s AS (SELECT cut.lang, cut.phrase, cut.a, j, x.f AS l, y.f AS r, 2000000 * cut.a // (x.f + y.f) AS score FROM cut
              JOIN f x ON x.lang = cut.lang AND x.k = j AND x.phrase = array_to_string(w[1:j], ' ')
              JOIN f y ON y.lang = cut.lang AND y.k = cut.k - j AND y.phrase = array_to_string(w[j + 1:cut.k], ' ')),
        best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS o FROM s) WHERE o = 1),
        sub AS (SELECT lang, a, w, k, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c)),
        inside AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer FROM sub GROUP BY ALL),
        listed AS (SELECT best.*, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, best.a DESC, best.phrase) AS rank
                   FROM best LEFT JOIN inside ON inside.lang = best.lang AND inside.phrase = best.phrase
                   WHERE coalesce(100 * longer < 80 * best.a, true))
        SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
        FROM listed JOIN n USING (lang) WHERE rank <= 2000""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))
