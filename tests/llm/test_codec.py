"""Ids against the public library, round trips, and the streaming window."""

import os
import random

import pytest

from shortlist.llm.queries import PIECE_MODEL
from shortlist.llm.sentencepiece_codec import SPACE, Codec, decode, encode

pytestmark = pytest.mark.skipif(not os.path.exists(PIECE_MODEL), reason="no model file")
PARTS = ["a", "b", "the", "in", " ", "  ", "ing", "er", "é", "漢", "😀", ".", "\n", "tion", "1", "0", "<s>", "<0x0A>", "\x00"]


@pytest.fixture(scope="module")
def codec():
    return Codec.load(PIECE_MODEL)


def texts():
    rng = random.Random(8)
    out = ["", " ", "   ", "a", "\n", "日本語", "aaaaaaaaaaaaaaaaaaaaaaaa", "x" * 5000, "".join(rng.choice("abcdeinthg") for _ in range(30_000))]
    return out + ["".join(rng.choice(PARTS) for _ in range(rng.randrange(40))) for _ in range(1500)]


def test_same_ids_as_the_library(codec):
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=PIECE_MODEL)
    import pyarrow as pa

    own = texts()
    want = library.encode(own)
    assert [codec.encode(t) for t in own] == want
    assert codec.encode_column(pa.array(own)).to_pylist() == want
    assert [codec.decode(i) for i in want] == own


def test_ids_are_given_out_before_the_text_ends(codec):
    """The open window stays small on a text without a blank."""
    seen = 0

    class Watched(str):
        def __getitem__(self, at):
            nonlocal seen
            seen = max(seen, at if isinstance(at, int) else at.stop)
            return super().__getitem__(at)

    first = next(iter(codec.pieces(Watched(SPACE + "international" * 400))))
    assert codec.text[first].startswith(SPACE) and seen < 8 * codec.longest


def test_unigram_takes_the_highest_sum():
    pieces = [("<unk>", 0.0, 2), ("▁", -1.0, 1), ("a", -2.0, 1), ("b", -2.0, 1), ("ab", -3.0, 1), ("▁a", -2.5, 1), ("ba", -9.0, 1), ("aba", -4.0, 1)]
    codec = Codec(pieces, 1, False, True)
    scores = {p: s for p, s, kind in pieces if kind == 1}

    def best(text):
        if not text:
            return 0.0, []
        options = []
        for n in range(1, len(text) + 1):
            score = scores.get(text[:n], codec.unknown_score if n == 1 else None)
            if score is not None:
                rest = best(text[n:])
                options.append((score + rest[0], [text[:n], *rest[1]]))
        return max(options, key=lambda o: o[0])

    rng = random.Random(9)
    for _ in range(300):
        text = SPACE + "".join(rng.choice("abc") for _ in range(rng.randrange(9)))
        got = [codec._string(i) for i in codec.pieces(text)]
        assert "".join(got) == text
        assert abs(sum(scores.get(p, codec.unknown_score) for p in got) - best(text)[0]) < 1e-9


def test_tables(docs):
    rows = [(1, None), (2, ""), (3, "Hello  world"), (3, "Hello  world"), (None, "x" * 200_000), (4, "a▁b")]
    frame = docs(rows)
    coded = decode(encode(frame, PIECE_MODEL), PIECE_MODEL)
    assert set(coded.columns) == {*frame.columns, "decoded"}
    got = sorted(((r.doc_id, r.decoded) for r in coded.collect()), key=str)
    assert got == sorted([(i, (t or "").replace("▁", " ")) for i, t in rows], key=str)
    assert encode(docs([]), PIECE_MODEL).count() == 0
