"""Encoding, packing and splitting."""

import random

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from chronoflow.llm.bpe import encoder  # noqa: E402
from chronoflow.llm.encoding import decode_ids, default_vocabulary, encode_texts  # noqa: E402
from chronoflow.llm.packing import pack, plan  # noqa: E402
from chronoflow.llm.splitting import cuts, split_texts  # noqa: E402

SCHEMA = "id bigint, text string, k int, x string, ids string, container int"


@pytest.fixture(scope="module")
def theirs():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


SAMPLES = ["", " ", "  \n\n\t x", "don't I'LL we've", "a" * 5000, "ab" * 3000 + "  ", "½Ⅷ 三つの word", "é​﻿\x00\x1c\x85\xa0", "🙂🙃 👩‍👩‍👧", "<|endoftext|>", "0123456789" * 20, " 　  x"]


def test_equals_library(theirs):
    own = encoder(default_vocabulary())
    for text in SAMPLES:
        assert own.encode(text) == theirs(text), text[:40]
        assert own.decode(own.encode(text)) == text


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_equals_library_on_any_text(text):
    from tokenizers import Tokenizer

    global _lib
    try:
        lib = _lib
    except NameError:
        lib = _lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
        lib.encode_special_tokens = True
    own = encoder(default_vocabulary())
    assert own.encode(text) == lib.encode(text, add_special_tokens=False).ids
    assert own.decode(own.encode(text)) == text


def test_frames(spark):
    rows = [(i, t, 1, "x", None, 1) for i, t in enumerate([*SAMPLES, None, "twice", "twice"])]
    df = spark.createDataFrame(rows, SCHEMA)
    ids = encode_texts(df, "id", "text", default_vocabulary())
    got = {r.id: r.ids for r in ids.collect()}
    assert got[len(SAMPLES)] == [] and got[0] == [] and len(got) == len(rows)
    assert {r.id: r.text for r in decode_ids(ids, "id", "ids", default_vocabulary()).collect()} == {r[0]: r[1] or "" for r in rows}
    assert encode_texts(spark.createDataFrame([], SCHEMA), "id", "text", default_vocabulary()).count() == 0


def test_plan_holds_histogram():
    rnd = np.random.default_rng(2)
    for n in (0, 1, 3, 50, 4000):
        lengths = np.minimum(rnd.geometric(0.02, n), 256)
        histogram = np.bincount(lengths, minlength=257)
        held = np.zeros(257, int)
        boxes = 0
        for items, k in plan(histogram, 256):
            assert sum(items) <= 256
            boxes += k
            for v in items:
                held[v] += k
        assert (held == histogram).all()
        assert boxes <= 1.02 * lengths.sum() / 256 + 2


def test_pack(spark):
    rnd = random.Random(1)
    texts = [None, "", "word " * 700] + ["word " * rnd.randrange(1, 60) for _ in range(300)] + ["same text"] * 40
    df = spark.createDataFrame([(i, t, 1, "x", None, 1) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    rows = pack(df, "id", "text", default_vocabulary(), 128).collect()
    room, whole = {}, {}
    for r in rows:
        room[r.container] = room.get(r.container, 0) + r.tokens
        whole.setdefault(r.id, []).append((r.part, r.tokens))
    assert sorted(whole) == list(range(len(texts)))
    assert max(room.values()) <= 128 and len(room) <= sum(room.values()) / 128 * 1.03 + 2
    own = encoder(default_vocabulary())
    for i, parts in whole.items():
        n = len(own.encode(texts[i]))
        assert sum(t for _, t in parts) == n and len(parts) == max(1, -(-n // 128))
    empty = pack(spark.createDataFrame([], SCHEMA), "id", "text", default_vocabulary(), 128)
    assert empty.count() == 0
    blank = pack(spark.createDataFrame([(1, None, 1, None, None, 1), (2, "", 1, None, None, 1)], SCHEMA), "id", "text", default_vocabulary(), 128)
    assert {(r.id, r.tokens, r.container) for r in blank.collect()} == {(1, 0, 0), (2, 0, 0)}


def test_cuts():
    own = encoder(default_vocabulary())
    rnd = random.Random(6)
    sentence = lambda: " ".join(rnd.choice(["Łódź", "word", "naïve", "三つ", "🙂"]) for _ in range(rnd.randrange(2, 30))) + rnd.choice([". ", "! ", ".\n\n", ", "])
    for text in ["".join(sentence() for _ in range(200)), "x" * 9000, "三" * 3000, "🙂" * 500, " " * 4000, "a b " * 2000, "word. " * 900]:
        for limit, overlap in ((64, 8), (20, 0), (128, 100)):
            pieces = cuts(own, text, limit, overlap)
            assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
            assert all(n <= limit for _, _, n, _ in pieces)
            for (s, e, *_), (s2, e2, *_) in zip(pieces, pieces[1:]):
                assert s < s2 <= e < e2
    natural = cuts(own, "One two three. " * 200, 50, 5)
    assert {k for *_, k in natural[:-1]} == {"sentence"}


def test_split_frame(spark):
    rows = [(1, None), (2, ""), (3, "short"), (4, "One two three. " * 100), (4, "One two three. " * 100)]
    df = spark.createDataFrame([(i, t, 1, "x", None, 1) for i, t in rows], SCHEMA)
    out = split_texts(df, "id", "text", default_vocabulary(), 50, 5).collect()
    assert {r.id for r in out} == {3, 4}
    assert all(r.text == dict(rows)[r.id][r.start : r.stop] for r in out)
    with pytest.raises(ValueError):
        split_texts(df, "id", "text", default_vocabulary(), 5, 5)
