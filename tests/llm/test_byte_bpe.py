"""Operator 13 against the tiktoken library, and its scan against a walk state by state."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tallyward.llm import byte_bpe
from tallyward.llm.tables import ready

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, ids string, offsets string, n_tokens string"
ODD = ["", None, " ", "a", "  a", "it's 'tis 'LL 're''s", "<|endoftext|>x", "\n\n b", "\t　c", "x " * 9 + "é中文😀", "'", "''ll l'v'e"]


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.ByteBpe(PATH, most=400)


@pytest.fixture(scope="module")
def library(coder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})


def noise(n, seed, longest=60):
    rng = random.Random(seed)
    pool = list("ab'sSrevlmdtT09 \n.,!?é’ßİ中ǅ²½☃😀") + ["'re", "'ll", "'v", "''", "\x0b", "\x1c", "\x85", "​", "　", "\xa0", "  ", "the"]
    return ["".join(rng.choice(pool) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def test_encoder_agrees_with_the_library(coder, library):
    texts = [*noise(3000, 1), *[t or "" for t in ODD], "a" * 5000, "x'" * 400, " " * 999 + "b", "中" * 1500]
    for some in (texts[:700], texts[700:]):
        ids, counts, offsets = coder.encode(some)
        want = [library.encode_ordinary(t) for t in some]
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]
        assert coder.decode(ids) == "".join(some).encode()
        at = 0
        for text, n in zip(some, counts.tolist()):
            places = offsets[at:at + n].tolist() + [len(text.encode())]
            own = [text.encode()[a:b] for a, b in zip(places, places[1:])]
            assert own == [coder.decode(ids[i:i + 1]) for i in range(at, at + n)]
            at += n


def test_code_points(coder, library):
    every = [chr(c) for c in [*range(0x3100), *range(0x3100, 0x110000, 13)] if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}{c}1{c}!{c} {c}" for c in every[i:i + 400]) for i in range(0, len(every), 400)]
    ids, counts, _ = coder.encode(texts)
    ends = np.cumsum(counts).tolist()
    for text, a, b in zip(texts, [0, *ends], ends):
        assert ids[a:b].tolist() == library.encode_ordinary(text)


def test_scan_is_the_walk():
    rng = np.random.default_rng(5)
    for n in (1, 7, 256, 257, 3000):
        kinds = rng.integers(0, 8, n)
        walked, state = [], byte_bpe.NEW
        for k in kinds:
            state = byte_bpe._step(state, k)[0]
            walked.append(state)
        assert byte_bpe.STATE[byte_bpe.compose_prefixes(byte_bpe.FUNCTION[kinds]), byte_bpe.NEW].tolist() == walked


def test_long_and_short_merges_are_the_same(coder):
    for piece in (t.encode() for t in noise(300, 9, 20)):
        if piece and piece not in coder.ranks:
            assert byte_bpe._merge_long(piece, coder.ranks) == byte_bpe.merge_pairs(piece, coder.ranks)


def test_parts_encode_like_the_whole(coder, library):
    for text in [*noise(40, 3, 400), "x" * 500, " " * 300, "it's 'll " * 60]:
        cut = list(byte_bpe.parts(text, 50))
        assert "".join(cut) == text
        assert [i for p in cut for i in coder.encode([p])[0].tolist()] == library.encode_ordinary(text)


def test_tables(spark, library):
    ready(spark)
    long = ("Of the thing, don't " * 8000) + "y" * 4000
    rows = [(i, t, "clash", None, "n") for i, t in enumerate([*ODD, long, *noise(50, 4)])]
    rows += [(1, None, None, None, None), (None, "no id", None, None, None), (3, "a", "clash", None, "n")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = Counter()
    for i, t, *_ in rows:
        ids = library.encode_ordinary(t or "")
        packed = np.array(ids, "<u4").tobytes()
        want[i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    got = byte_bpe.round_trip(docs, PATH)
    assert Counter(map(tuple, got.collect())) == want
    encoded = byte_bpe.encode(docs, PATH)
    assert Counter((r.doc_id, tuple(r.ids)) for r in encoded.collect()) == Counter(
        (i, tuple(library.encode_ordinary(t or ""))) for i, t, *_ in rows)
    back = byte_bpe.decode(encoded, PATH)
    assert Counter((r.doc_id, bytes(r.data)) for r in back.collect()) == Counter((i, (t or "").encode()) for i, t, *_ in rows)
    last = encoded.filter(F.size("ids") > 0).select(F.element_at("offsets", -1).alias("o"), F.element_at("ids", -1).alias("i"), "doc_id")
    for r in last.collect():
        lengths = {len((t or "").encode()) for i, t, *_ in rows if i == r.doc_id}
        assert r.o + len(library.decode_single_token_bytes(r.i)) in lengths
    empty = docs.limit(0)
    assert byte_bpe.round_trip(empty, PATH).count() == 0 and byte_bpe.encode(empty, PATH).count() == 0
