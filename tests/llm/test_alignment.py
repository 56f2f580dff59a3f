"""Operator 11 against a plain alignment of whole documents, byte by byte."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from tokenizers import Tokenizer

from tallyward.llm import alignment
from tallyward.llm.tables import ready, table

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, block string, number string, pair string"
ODD = ["", None, " ", "a", "  two  blanks ", "<|endoftext|> <s> </s> <unk>", "tab\tand\nline", "é中文😀 ﬁ", "▁ mark", "x" * 300, "don't it's", "\x00"]


@pytest.fixture(scope="module")
def worker():
    return alignment.Aligner(A, B)


library = Tokenizer.from_file(A)
library.encode_special_tokens = True


def plain(worker, texts):
    """What the contract says, from whole texts and single bytes."""
    rows, holders = [], defaultdict(set)
    for d, text in enumerate(texts):
        rows.append(None)
        if not text:
            continue
        want = (" " + text).encode()
        a = library.encode(" " + text, add_special_tokens=False).ids
        b = worker.sp.encode(text)
        spell_a = [worker.a.spell(np.array([i])) for i in a]
        spell_b = [worker.b.spell(np.array([i])) for i in b]
        if b"".join(spell_a) != want or b"".join(spell_b) != want:
            continue
        of_a = [i for i, s in enumerate(spell_a) for _ in s]
        of_b = [i for i, s in enumerate(spell_b) for _ in s]
        links = sorted(set(zip(of_a, of_b)))
        groups, begin = [], 0
        for at in range(1, len(want) + 1):
            if at == len(want) or of_a[at] != of_a[at - 1] and of_b[at] != of_b[at - 1]:
                groups.append(",".join(str(a[i]) for i in dict.fromkeys(of_a[begin:at])) + "|"
                              + ",".join(str(b[i]) for i in dict.fromkeys(of_b[begin:at])))
                begin = at
        pairs = [(a[i], b[j]) for i, j in links]
        for p in pairs:
            holders[p].add(d)
        rows[-1] = (len(a), len(b), groups, pairs)
    best = Counter()
    for (x, _), docs in holders.items():
        best[x] = max(best[x], len(docs))
    out = []
    for row in rows:
        if row is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, pairs = row
        counts = [len(holders[p]) for p in pairs]
        out.append((n_a, n_b, len(groups), len(pairs), sum(c == best[p[0]] for p, c in zip(pairs, counts)),
                    sum(counts), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


def noise(n, seed):
    rng = random.Random(seed)
    pool = [*"abehlnorst .,'!?0\n", "é", "中", "😀", " the", " of", "ing", "ﬁ", "  ", "\t", "er "]
    return ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def check(spark, worker, texts, **how):
    rows = [(i, t, "clash", None, "x") for i, t in enumerate(texts)]
    rows[3] = (None, *rows[3][1:])
    rows[4] = (5, *rows[4][1:])  # a repeated doc_id
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = alignment.alignments(docs, A, B, **how)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = Counter((r[0], *w) for r, w in zip(rows, plain(worker, texts)))
    assert Counter(map(tuple, got.collect())) == want
    assert any(w[1] for w in want)


def test_odd_texts(spark, worker):
    ready(spark)
    texts = [*ODD, *noise(120, 1), "same text here", "same text here"]
    check(spark, worker, texts)
    check(spark, worker, texts, block_chars=200)  # many blocks


def test_real_texts(spark, worker, smoke_dir):
    texts = [r[0] for r in table(spark, smoke_dir, "documents").select("text").limit(60).collect()]
    check(spark, worker, [*ODD, *texts])


def test_long_texts_are_cut_alike(worker, monkeypatch):
    texts = ["of the thing and, don't stop " * 60, "y" * 900 + " z", *noise(30, 7)]
    whole = worker.align(texts)
    monkeypatch.setattr(alignment, "PART", 100)
    assert worker.cuts
    cut = worker.align(texts)
    for x, y in zip(whole, cut):
        assert list(x) == list(y)


def test_memo_is_bounded_and_changes_nothing(worker):
    texts = [*noise(200, 2), "x" * 3000, "plain words " * 50]
    small = alignment.Windows(worker.a, worker.b, most=20, longest=6)
    want = [worker.align(texts[i:i + 20]) for i in range(0, len(texts), 20)]
    kept, worker.windows = worker.windows, small
    try:
        got = [worker.align(texts[i:i + 20]) for i in range(0, len(texts), 20)]
    finally:
        worker.windows = kept
    for x, y in zip(want, got):
        assert all(list(p) == list(q) for p, q in zip(x, y))


def test_ids_of_a_are_the_library_s(worker):
    points = [chr(c) for c in [*range(0x3100), *range(0x3100, 0x110000, 101)] if not 0xD800 <= c < 0xE000]
    texts = [*noise(500, 11), *["".join(f"a{c}{c}1{c}!{c} {c}'s" for c in points[i:i + 50]) for i in range(0, len(points), 50)]]
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    blank = "a" + " " * 300_000 + "b\n"
    assert len(worker.align([blank])[4][0]) == 64
    assert [worker.tok.encode_ordinary(t) for t in texts] == want


def test_windows_of_equal_ids_split_differently(worker):
    """The ids 300, 300, 300 as two of A and one of B, or one and two."""
    a = alignment.Spelling([b"x"] * 300 + [b"ab"])
    b = alignment.Spelling([b"x"] * 300 + [b"abab"])
    memo = alignment.Windows(a, b)
    of_a, of_b = np.array([300], np.uint32), np.array([300], np.uint32) | alignment.OF_B
    two = np.concatenate([of_a, of_a, of_b]).tobytes()
    memo.b, memo.a = a, b
    memo.find([np.concatenate([of_a, of_b, of_b]).tobytes()], [1])
    memo.a, memo.b = a, b
    slots, _ = memo.find([two], [2])
    assert memo.text[slots[0]] == b"300,300|300"


def test_empty_table(spark):
    ready(spark)
    assert alignment.alignments(spark.createDataFrame([], SCHEMA), A, B).count() == 0
