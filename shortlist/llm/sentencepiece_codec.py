"""SentencePiece ids of texts, by a streaming Viterbi search, and texts of ids."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shortlist.llm import words

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6  # fixed: piece types of a model file
UNIGRAM, BPE = 1, 2  # fixed: model types
DECODE_IDS = 1 << 18
UNKNOWN_PENALTY = 10.0  # fixed: an unknown character scores so much less than the worst piece
CACHE_CHARS, CACHE_ENTRIES = 48, 400_000
CACHE_PAIRS = 1 << 19


class Codec:
    """Encoder and decoder of one model.

    The search runs over the positions of a text. A position keeps its best last piece; only the
    positions less than the longest piece behind the front can still be continued, so whenever the
    paths back from all of those meet in one position, everything up to it is final and is given
    out, and memory holds the open window alone. For a unigram model the best path has the highest
    sum of scores. For a BPE model a piece may follow another only if the two, merged by score,
    stay these two; by this rule exactly one path reaches each position, and it is the BPE result.
    """

    def __init__(self, pieces: list[tuple[str, float, int]], model_type: int, byte_fallback: bool, add_prefix: bool):
        if model_type not in (UNIGRAM, BPE):
            raise ValueError("unigram and BPE models are supported")
        self.bpe, self.byte_fallback, self.add_prefix = model_type == BPE, byte_fallback, add_prefix
        self.text = [p for p, _, _ in pieces]
        self.score = [s for _, s, _ in pieces]
        self.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, USER)}
        self.longest = max(map(len, self.ids), default=1)
        self.unknown_id = next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), 0)
        self.unknown_score = min((self.score[i] for i in self.ids.values()), default=0.0) - UNKNOWN_PENALTY
        self.bytes = {int(p[1:-1], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        self.surface = [self._surface(p, kind) for p, _, kind in pieces]
        # if no piece has a blank behind another character, every path breaks before each such blank
        self.breaks = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.words = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        # character -> (id of the piece that ends here or None, the continuations)
        self.trie: dict = {}
        for piece, i in self.ids.items():
            node = self.trie
            for ch in piece[:-1]:
                node = node.setdefault(ch, [None, {}])[1]
            node.setdefault(piece[-1], [None, {}])[0] = i
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.edges: dict[int, tuple] = {}

    @classmethod
    def load(cls, path: str) -> Codec:
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm = model.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("models that change the text before encoding it are not supported")
        spec = model.trainer_spec
        return cls([(p.piece, p.score, p.type) for p in model.pieces], spec.model_type, spec.byte_fallback, norm.add_dummy_prefix)

    @staticmethod
    def _surface(piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[1:-1], 16)])
        if kind == CONTROL:
            return b""
        return " ⁇ ".encode() if kind == UNKNOWN else piece.replace(SPACE, " ").encode()

    # A character that is no piece is numbered behind the pieces by its code point.
    def _string(self, symbol: int) -> str:
        return self.text[symbol] if symbol < len(self.text) else chr(symbol - len(self.text))

    def _merged(self, text: str) -> tuple[list[str], list, list, bool]:
        """BPE of a short text by its definition, joining the best-scored neighbours, leftmost
        first: the parts, what stood at the left and at the right edge in turn, each with the score
        that made it, and whether every join had a lower score than those before it."""
        parts = list(text)
        left, right = [(parts[0], 0.0)], [(parts[-1], 0.0)]
        falling, before = True, float("inf")
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                piece = self.ids.get(parts[i] + parts[i + 1])
                if piece is not None and (best is None or self.score[piece] > best):
                    best, at = self.score[piece], i
            if at < 0:
                return parts, left, right, falling
            falling, before = falling and best <= before, best
            if at == 0:
                left.append((parts[0] + parts[1], best))
            if at == len(parts) - 2:
                right.append((parts[-2] + parts[-1], best))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _edges(self, symbol: int) -> tuple:
        known = self.edges.get(symbol)
        if known is None:
            parts, left, right, falling = self._merged(self._string(symbol))
            known = self.edges[symbol] = (left, right, falling and len(parts) == 1)
        return known

    def _may_follow(self, a: int, b: int) -> bool:
        """Whether BPE of the two pieces' text gives these two. While they are built, what stands
        on both sides of the border must never be joined before one side grows."""
        (_, lefts, plain_a), (rights, _, plain_b) = self._edges(a), self._edges(b)
        if not (plain_a and plain_b):
            first, second = self._string(a), self._string(b)
            return self._merged(first + second)[0] == [first, second]
        i = j = 0
        never = float("-inf")
        while True:
            grows_a = lefts[i + 1][1] if i + 1 < len(lefts) else never
            grows_b = rights[j + 1][1] if j + 1 < len(rights) else never
            joined = self.ids.get(lefts[i][0] + rights[j][0])
            if joined is not None and self.score[joined] > grows_a and self.score[joined] >= grows_b:
                return False
            if grows_a == grows_b == never:
                return True
            if grows_a >= grows_b:
                i += 1
            else:
                j += 1

    def pieces(self, text: str) -> Iterator[int]:
        """The pieces of an escaped text, each as soon as no continuation can change it."""
        n, size = len(text), len(self.text)
        trie, pairs, bpe, window = self.trie, self.pairs, self.bpe, 4 * self.longest
        # of the positions from base on: start of the last piece, that piece, best sum
        room = min(n, window + self.longest) + 1
        base, back, last, total = 0, [-1] * room, [-1] * room, [0.0] * room
        for start in range(n):
            # every piece that could end here begins before, so this position's last piece is known
            at = start - base
            left, node, end = last[at], trie, start
            while end < n:
                found = node.get(text[end])
                end += 1
                if found is None:
                    if end - start > 1:
                        break
                    piece, node = size + ord(text[start]), {}
                else:
                    piece, node = found
                    if piece is None:
                        if end - start > 1:
                            continue
                        piece = size + ord(text[start])
                to = end - base
                if bpe:
                    if last[to] < 0:
                        if left < 0:
                            back[to], last[to] = start, piece
                        else:
                            code = left << 24 | piece
                            fits = pairs.get(code)
                            if fits is None:
                                if len(pairs) >= CACHE_PAIRS:
                                    pairs.clear()
                                fits = pairs[code] = self._may_follow(left, piece)
                            if fits:
                                back[to], last[to] = start, piece
                        if end == n and last[to] >= 0:
                            # one path reaches each position, and that of the end is complete
                            yield from self._path(back, last, base, n)
                            return
                else:
                    value = total[at] + (self.score[piece] if piece < size else self.unknown_score)
                    if last[to] < 0 or value > total[to]:
                        back[to], last[to], total[to] = start, piece, value
            if at >= window:
                meet = self._meeting(back, last, base, start)
                if meet > base:
                    yield from self._path(back, last, base, meet)
                    # the piece before the meeting point stays known for what follows it
                    done, base = meet - base, meet
                    back, last, total = (x[done:] + [empty] * done for x, empty in ((back, -1), (last, -1), (total, 0.0)))
                else:
                    # nothing is decided yet: the window grows
                    back, last, total = (x + [empty] * window for x, empty in ((back, -1), (last, -1), (total, 0.0)))
        yield from self._path(back, last, base, n)

    def _meeting(self, back: list[int], last: list[int], base: int, end: int) -> int:
        """The last position that the paths of all positions from which or beyond which the search
        goes on have in common."""
        open_ = {end, *(i for i in range(end + 1, base + len(back)) if last[i - base] >= 0)}
        while len(open_) > 1:
            top = max(open_)
            if top == base:
                break
            open_.remove(top)
            open_.add(max(back[top - base], base))
        return min(open_)

    @staticmethod
    def _path(back: list[int], last: list[int], base: int, end: int) -> list[int]:
        out = []
        while end > base:
            out.append(last[end - base])
            end = back[end - base]
        return out[::-1]

    def _ids_of(self, pieces: Iterator[int]) -> Iterator[int]:
        size = len(self.text)
        for piece in pieces:
            if piece < size:
                yield piece
            elif self.byte_fallback and self.bytes:
                yield from (self.bytes[b] for b in chr(piece - size).encode("utf-8", "surrogatepass"))
            else:
                yield self.unknown_id

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; none for a null or empty one."""
        if not text:
            return []
        text = text.replace(" ", SPACE)
        if self.add_prefix:
            text = SPACE + text
        if not self.breaks:
            return list(self._ids_of(self.pieces(text)))
        return [i for word in self.words.findall(text) for i in self._ids_of(self.pieces(word))]

    def encode_column(self, column: pa.Array) -> pa.ListArray:
        """Ids of each text of an Arrow column. Words are told apart by their hashes, each is
        searched once in a chunk of texts, and its ids are copied to all its places."""
        column = column.cast(pa.string()).fill_null("")
        if not (self.breaks and self.add_prefix) or pc.any(pc.match_substring(column, SPACE)).as_py():
            return pa.array([self.encode(t.as_py()) for t in column], pa.list_(pa.int32()))
        counts, parts = [np.zeros(1, np.int64)], []
        for first, last, raw, offsets in words.chunks(column):
            n = last - first
            # every text gets the blank that the model puts before it; an empty one stays empty
            sizes = np.diff(offsets)
            begins = np.flatnonzero(sizes)
            raw = np.insert(raw, offsets[begins], 0x20)
            bounds = np.concatenate([[0], np.cumsum(sizes + (sizes > 0))])
            blank = raw == 0x20
            starts = blank.copy()
            starts[1:] &= ~blank[:-1]
            starts[bounds[begins]] = True
            starts = np.flatnonzero(starts)
            ends = np.append(starts[1:], len(raw))
            hashes = words.word_hashes(raw, starts, ends, words.SAME)
            _, where, which = np.unique(hashes, return_index=True, return_inverse=True)
            lists = [self._word_ids(raw[starts[i] : ends[i]].tobytes()) for i in where]
            lengths = np.fromiter(map(len, lists), np.int64, len(lists)) // 4
            flat = np.frombuffer(b"".join(lists), np.int32)
            at = np.concatenate([[0], np.cumsum(lengths)])
            each = lengths[which]
            edges = np.concatenate([[0], np.cumsum(each)])
            parts.append(flat[np.repeat(at[:-1][which] - edges[:-1], each) + np.arange(edges[-1])])
            counts.append(np.diff(edges[np.searchsorted(starts, bounds)]))
        flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(counts)), pa.int32()), pa.array(flat, pa.int32()))

    def _word_ids(self, word: bytes) -> bytes:
        """The ids of a word, four bytes each."""
        ids = self.cache.get(word)
        if ids is None:
            # words that were not asked for since the cache was last full are forgotten
            ids = self.older.get(word)
            if ids is None:
                ids = array("i", self._ids_of(self.pieces(word.decode().replace(" ", SPACE)))).tobytes()
            if len(word) <= CACHE_CHARS:
                if len(self.cache) >= CACHE_ENTRIES:
                    self.cache, self.older = {}, self.cache
                self.cache[word] = ids
        return ids

    def decode(self, ids) -> str:
        """Text of ids; bytes that are no UTF-8 become replacement characters."""
        return self._unescaped(b"".join([self.surface[i] for i in ids]))

    def _unescaped(self, raw: bytes) -> str:
        text = raw.decode("utf-8", "replace")
        return text[1:] if self.add_prefix and text[:1] == " " else text

    def decode_column(self, column: pa.ListArray) -> pa.Array:
        """Text of each row of ids: the pieces' bytes are gathered for many rows at once."""
        lengths = np.array([len(x) for x in self.surface])
        at = np.concatenate([[0], np.cumsum(lengths)])
        table = np.frombuffer(b"".join(self.surface), np.uint8)
        rows = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
        edges = np.concatenate([[0], np.cumsum(rows)])
        ids, out = column.flatten().to_numpy(zero_copy_only=False), []
        first = 0
        while first < len(rows):
            # a row, or as many as a bounded number of ids
            last = max(int(np.searchsorted(edges, edges[first] + DECODE_IDS, "right")) - 1, first + 1)
            own = ids[edges[first] : edges[last]]
            sizes = lengths[own]
            ends = np.concatenate([[0], np.cumsum(sizes)])
            raw = table[np.repeat(at[own] - ends[:-1], sizes) + np.arange(ends[-1])].tobytes()
            cuts = ends[edges[first : last + 1] - edges[first]].tolist()
            out += [self._unescaped(raw[a:b]) for a, b in zip(cuts, cuts[1:])]
            first = last
        return pa.array(out, pa.string())


def _with_column(docs: DataFrame, name: str, kind: T.DataType, values) -> DataFrame:
    kept = [c for c in docs.columns if c != name]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], values(batch)], names=[*kept, name])

    return docs.mapInArrow(add, T.StructType([*[docs.schema[c] for c in kept], T.StructField(name, kind)]))


def encode(docs: DataFrame, model_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with an array column ``ids``, in the place of one of that name. Null and empty texts have no ids.

    The ids equal those of the public library for the same model. A U+2581 in a text is a blank to
    every such model. The model file is read on the driver; its pieces, as many as the vocabulary
    has, go to the workers once. A text is searched word by word where the model lets no piece
    cross a word's start, and in a window of a few longest pieces otherwise.
    """
    held = docs.sparkSession.sparkContext.broadcast(Codec.load(model_path))

    def values(batch: pa.RecordBatch) -> pa.Array:
        return held.value.encode_column(batch.column(text))

    return _with_column(docs, ids, T.ArrayType(T.IntegerType()), values)


def decode(docs: DataFrame, model_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with a string column ``text``, in the place of one of that name, made of the ids. Null ids are an empty text."""
    held = docs.sparkSession.sparkContext.broadcast(Codec.load(model_path))

    def values(batch: pa.RecordBatch) -> pa.Array:
        return held.value.decode_column(batch.column(ids))

    return _with_column(docs, text, T.StringType(), values)
