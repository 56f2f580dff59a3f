"""Operators over single texts, each against the library or a plain model of it."""

import random
import zlib
from collections import Counter, defaultdict
from math import exp, log, log10

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyward.llm import attention_lm, direct_codes, language, packing, segmentations, token_counts, word_hashes
from tallyward.llm.pretokens import WordIds
from tallyward.llm.tables import ready, table

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_tokens string, part string, row string"
LONG = ("Of the thing and " * 4000) + "x" * 5000 + "'ll don't 12,5 é中文 <|endoftext|>" + " \n\t"
ODD = ["", None, " ", "a", "it's 'tis 'll 're", "<|endoftext|>x<|startoftext|>", "ÉÀß 中文 İı é 😀", "12 3½ ²", "''s", LONG]


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def odd(spark):
    ready(spark)
    rows = [(i, t, "en", None, "clash", None, "r") for i, t in enumerate(ODD)]
    rows += [(1, None, None, None, None, None, None), (None, "no id here", "de", "s", None, None, None), (3, "a", "en", None, "clash", None, "r")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def ids_of(tok, text, end=False):
    return tok.encode(text or "", add_special_tokens=False).ids + ([2] if end else [])


def noise(n, seed):
    rng = random.Random(seed)
    pool = list("ab'sSrevlmdtT09 \n.,!?é’ßİIı中ǅ²½₂☃😀") + ["'re", "'ll", "'v", "<|endoftext|>", "''", "\x0b", "\x85", "​", "̈", "the", "ing"]
    return ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_encoder_and_transducer_agree_with_the_library(tok):
    texts = [*noise(1500, 3), *[t or "" for t in ODD], "'" * 900, "ab" * 700 + "'ll", " " * 700, "中" * 600 + "a 'rb"]
    want = [x.ids for x in tok.encode_batch(texts, add_special_tokens=False)]
    ids, counts = WordIds(WORDS, most=500).encode(texts)
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]
    small = token_counts.Transducer(WORDS, cells=400_000)  # starts anew between the halves
    got = np.concatenate([small.count(texts[:800]), small.count(texts[800:])])
    assert got.tolist() == [len(w) for w in want]


def test_token_counts(spark, tok, odd, empty):
    got = token_counts.token_counts(odd, WORDS, limit=3)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = Counter()
    for r in odd.collect():
        n = len(ids_of(tok, r["text"]))
        want[r["doc_id"], len((r["text"] or "").encode()), n, n > 3] += 1
    assert Counter(map(tuple, got.collect())) == want
    assert token_counts.token_counts(empty, WORDS).count() == 0


def check_packing(rows, documents, size):
    """Every id of every document once, gapless sequences; the share of padding."""
    held, sequences, padding, total = defaultdict(list), defaultdict(list), 0, 0
    for r in rows:
        held[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc_id, texts in documents.items():
        pieces = Counter((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in held.pop(doc_id))
        for ids in texts:  # a repeated document may be cut in other ways
            at = 0
            while at < len(ids):
                fit = [p for p in pieces if pieces[p] and p[0] == at and p[3] == len(ids)
                       and zlib.crc32(np.array(ids[at:at + p[1]], np.uint32).tobytes()) == p[2]]
                assert fit
                pieces[fit[0]] -= 1
                at += fit[0][1]
        assert not +pieces
    assert not held
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end and length > 0
            end += length
        assert end <= size
        total += end
        padding += 0 if end & (end - 1) == 0 else size - end
    return padding / max(total, 1)


@pytest.mark.parametrize("windows", [2, 64])
def test_packing_odd_rows(spark, tok, odd, empty, windows):
    documents = defaultdict(list)
    for r in odd.collect():
        documents[r["doc_id"]].append(ids_of(tok, r["text"], True))
    assert check_packing(packing.pack(odd, WORDS, windows=windows).collect(), documents, packing.SIZE) == 0
    assert packing.pack(empty, WORDS).count() == 0


def test_packing_many_partitions(spark, tok, smoke_dir):
    docs = table(spark, smoke_dir, "documents").repartition(40)
    documents = {r["doc_id"]: [ids_of(tok, r["text"], True)] for r in docs.collect()}
    assert check_packing(packing.pack(docs, WORDS, windows=4).collect(), documents, packing.SIZE) < 0.02
    assert check_packing(packing.pack(docs, WORDS, size=256, windows=4).collect(), documents, 256) < 0.05


def test_direct_codes_round_trip(spark, tok, odd, empty):
    got = sorted(direct_codes.round_trip(odd, WORDS).collect(), key=lambda r: r["start"])
    at, keys = 0, []
    want = defaultdict(list)
    for r in odd.collect():
        want[r["doc_id"]].append(ids_of(tok, r["text"], True))
    for r in got:
        own = next(w for w in want[r["doc_id"]] if zlib.crc32(np.array(w, np.uint32).tobytes()) == r["ids_crc32"])
        want[r["doc_id"]].remove(own)
        assert (r["start"], r["n_tokens"]) == (at, len(own))
        at, keys = at + len(own), [*keys, r["doc_id"]]
    assert not any(want.values()) and keys[0] is None and keys[1:] == sorted(keys[1:])
    assert direct_codes.round_trip(empty, WORDS).count() == 0


def test_direct_codes_read_tasks_grow_with_the_files(spark, tmp_path):
    docs = ready(spark).range(3500).selectExpr("id as doc_id", "concat('some words ', id) as text")
    files = direct_codes.write(docs, WORDS, str(tmp_path), file_ids=1)
    assert files.count() >= 3
    assert direct_codes.read(files, str(tmp_path)).rdd.getNumPartitions() == files.count()


def test_direct_codes_single_tokens():
    rng = np.random.default_rng(1)
    ids = np.concatenate([rng.integers(0, 50, 3000), rng.integers(0, 60000, 3000), [0, 2**32 - 1, 4095, 4096, 65535, 65536]]).astype(np.uint32)
    for widths in ((12, 4, 16), (3, 29), (32,), (8, 8, 8, 8)):
        codes = direct_codes.Codes(direct_codes.encode([7, None], np.array([6000, 6]), ids, widths))
        assert codes.all().tolist() == ids.tolist() and codes.doc_id == [7, None]
        for i in [0, 511, 512, 513, 1024, 2999, 3000, *range(5990, 6006)]:
            assert codes[i] == ids[i]
    with pytest.raises(ValueError):
        direct_codes.encode([1], np.array([1]), np.array([1 << 20], np.uint32), (8, 8))


def test_language(spark, odd, empty, smoke_dir):
    docs = table(spark, smoke_dir, "documents")
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [r for r in language.identify(docs).collect() if r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in held)
    assert sum(lang[r["doc_id"]] == r["lang_pred"] for r in held) >= 0.95 * len(held) > 0
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in language.identify(odd).collect()]
    assert len(got) == odd.count()
    assert all(p == "und" and s == 0 for i, p, s in got if i in (0, 1, 2, 7))
    assert all(0 <= s <= 1 for _, _, s in got)
    assert language.identify(empty).count() == 0
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.identify(unlabelled).collect()} == {"und"}
    kept = language.known_documents(odd)
    assert kept.columns == odd.columns and kept.count() == sum(p != "und" for _, p, _ in got)


def test_language_counts_match_a_plain_model():
    texts = ["Ab c", "", "ñandú x9"]
    found, begin, letters = language.features(texts, 1 << 15)
    alone = [language.features([t], 1 << 15) for t in texts]
    assert np.concatenate([a[0] for a in alone], axis=1).tolist() == found.tolist()
    assert letters.tolist() == [3, 0, 6] and begin.tolist() == [0, 5, 6]


def plain_base(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    cut = lambda t: __import__("re").findall("[^\x20\x09-\x0d]+", (t or "").translate(lower))
    learns = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 != 1
    counts, documents = Counter(), 0
    for i, t in rows:
        if learns(i):
            counts.update(cut(t))
            documents += 1
    n, v = sum(counts.values()) + documents, len(counts) + (documents > 0)
    floor = log10(n + 0.5 * (v + 1))
    for i, t in rows:
        words = cut(t)
        yield (i, i is not None and not learns(i), len(words) + 1, sum(counts[w] > 0 for w in words) + (documents > 0), n,
               sum(log10(counts[w] + 0.5) - floor for w in words) + log10(documents + 0.5) - floor)


@pytest.mark.parametrize("frequent", [0, 5, 1 << 18])
def test_attention_scores(spark, odd, frequent):
    got = attention_lm.scored(odd, WORDS, frequent).collect()
    exact = lambda rows: sorted((str(r[0]), *r[1:5], round(r[5], 6)) for r in rows)
    assert exact(got) == exact(plain_base([(r["doc_id"], r["text"]) for r in odd.collect()]))
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_attention_is_a_distribution_and_learns(spark, empty, smoke_dir):
    model = attention_lm.Model(300)
    rng = np.random.default_rng(2)
    for name, n in attention_lm.TABLES.items():
        setattr(model, name, rng.normal(0, 1, (300, n)).astype(np.float32))
    model.emit(rng.random((300, attention_lm.Z)))
    ids = rng.integers(0, 300, 40)
    # Scores of all continuations of a beginning sum to one, also beyond the first window.
    for n in (0, 1, 20, 39):
        total = sum(10 ** (model.log10(np.append(ids[:n], y), np.array([n + 1]))[0] - (model.log10(ids[:n], np.array([n]))[0] if n else 0))
                    for y in range(300))
        assert abs(total - 1) < 1e-3
    assert attention_lm.scored(empty, WORDS).count() == 0
    # On text held out, the trained model beats the counts of single ids that it falls back on.
    docs = table(spark, smoke_dir, "documents")
    encoder = WordIds(WORDS)
    model = attention_lm.Model.unpacked(attention_lm.learn(attention_lm.gather(docs, WORDS), len(encoder.final)))
    held = [r["text"] for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1]
    ids, counts = encoder.encode(held, end=True)
    assert model.log10(ids.astype(np.int64), counts).sum() > 0.95 * np.log10(model.unigram[ids]).sum()


def test_attention_learns_from_every_id(spark):
    # Long documents: 8 MB in few ids, each of them a target whatever the size of the corpus.
    docs = spark.createDataFrame([(i, " responsibility" * 100_000) for i in range(8)], "doc_id long, text string")
    size = len(WordIds(WORDS).final)
    _, unigram, met, rows = attention_lm.learn(attention_lm.gather(docs, WORDS), size)
    learned = sum(zlib.crc32(str(i).encode()) % attention_lm.FOLDS != attention_lm.HELD for i in range(8))
    assert 5 <= learned and abs(rows[:, -attention_lm.Z:].sum(dtype=np.float64) / (learned * 100_001) - 1) < 1e-3


def test_segmentations(spark, odd, empty):
    rows = segmentations.sample_table(odd, PIECES, with_ids=True).collect()
    sp = segmentations.vocabulary(PIECES).library
    by = defaultdict(list)
    texts = defaultdict(set)
    for r in odd.collect():
        texts[r["doc_id"]].add(r["text"] or "")
    for r in rows:
        assert r["decodes"] and r["n_pieces"] == len(r["ids"])
        assert sp.decode(r["ids"]) in texts[r["doc_id"]]
        assert r["log_inclusion"] <= 0 and r["log_prob"] <= 1e-9
        by[r["doc_id"], r["sample"]].append(r)
    assert {r["n_pieces"] for r in rows if r["doc_id"] == 0} == {0}
    assert segmentations.sample_table(empty, PIECES).count() == 0
    again = segmentations.sample_table(odd.repartition(1), PIECES, with_ids=True).collect()
    told = lambda found: Counter((r["doc_id"], r["sample"], r["ids_crc32"], round(r["log_prob"], 6), round(r["perturbed"], 6)) for r in found)
    assert told(again) == told(rows)  # whatever the partitioning


def test_segmentations_are_samples_without_replacement():
    own = segmentations.vocabulary(PIECES)
    pieces = {own.library.id_to_piece(i): i for i in range(3, 32000) if not own.library.is_byte(i)}
    word, paths = "▁ab▁c", {}

    def go(at, ids, weight):
        if at == len(word):
            paths[tuple(ids)] = weight
        for end in range(at + 1, len(word) + 1):
            if (i := pieces.get(word[at:end])) is not None:
                go(end, [*ids, i], weight + own.weight[i])

    go(0, [], 0.0)
    whole = log(sum(exp(w) for w in paths.values()))
    share = {p: exp(w - whole) for p, w in paths.items()}
    n, pairs = 3000, Counter()
    for at in range(0, n, 500):
        found = defaultdict(list)
        for s in segmentations.segmentations(["ab c"] * 500, np.arange(at, at + 500), own, 2):
            assert abs(s["log_prob"] - log(share[tuple(s["ids"].tolist())])) < 1e-9
            found[s["text"]].append((s["perturbed"], tuple(s["ids"].tolist())))
        for (a, first), (b, second) in found.values():
            assert a > b and first != second
            pairs[first, second] += 1
    for (a, b), m in pairs.items():
        p = share[a] * share[b] / (1 - share[a])
        assert abs(m / n - p) < 5 * (p * (1 - p) / n) ** 0.5 + 1e-3


def thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_of_any_shape_have_their_own_hash(tok):
    """A polynomial modulo a power of two cannot tell these two apart."""
    s, t = thue_morse(2048)
    texts = [s, t, f"of {s} the", f"of {t} the"]
    ids, counts = WordIds(WORDS).encode(texts)
    ends = np.cumsum(counts).tolist()
    for text, a, b in zip(texts, [0, *ends], ends):
        assert ids[a:b].tolist() == ids_of(tok, text)
    found, n = word_hashes.words(texts + ["ab", "a", "b", "abcdefgh", "abcdefghi", "x" * 16, "x" * 17, "é", "e"])
    assert len(set(found.tolist())) == 2 + 2 + 9 and n.tolist() == [1, 1, 3, 3, *[1] * 9]
    own = segmentations.vocabulary(PIECES)
    for got in segmentations.segmentations(texts, np.arange(4), own, 1):
        assert own.library.decode(got["ids"].tolist()) == texts[got["text"]]


def plain_bayes(model, text):
    """Log prior and likelihood of every language, from one n-gram after the other."""
    found, _, _ = language.features([text], len(model.weights))
    total = [float(x) for x in model.prior]
    for bucket in found.ravel().tolist():
        for i in range(len(total)):
            total[i] += float(model.weights[bucket, i])
    return total


def test_naive_bayes_is_computed_as_written(monkeypatch):
    rng = np.random.default_rng(3)
    names = [f"l{i:03}" for i in range(100)]
    weights = np.log(rng.dirichlet(np.ones(64), 100).T).astype(np.float32)
    model = language.Model(names, np.log(rng.dirichlet(np.ones(100))), weights)
    texts = [*noise(60, 8), "a" * 400, "x y z"]
    monkeypatch.setattr(language, "BLOCK", 7)
    best, score, _ = model.score(texts)
    for text, got in zip(texts, best.tolist()):
        total = plain_bayes(model, text)
        assert total[got] == pytest.approx(max(total), abs=1e-6 * len(text) + 1e-9)
    assert ((0 < score) & (score <= 1)).all()


def test_a_rare_language_wins_where_the_whole_text_says_so():
    even = np.log(np.full(64, 1 / 64))
    model = language.Model(["common", "rare"], np.log([0.999, 0.001]), np.stack([even, even + 0.1], axis=1).astype(np.float32))
    assert model.score(["ab cd " * 30_000])[0].tolist() == [1]
    assert model.score(["ab"])[0].tolist() == [0]
    tie = language.Model(["b", "c"], np.log([0.5, 0.5]), np.stack([even, even], axis=1).astype(np.float32))
    assert tie.score(["some text"])[0].tolist() == [0]


def test_language_fills_null_and_clashing_columns(spark):
    ready(spark)
    rows = [(i, "the of and " * 5, "en", "x") for i in range(30)] + [(100 + i, "der die das " * 5, "de", "y") for i in range(30)]
    rows += [(200, "die der das", None, "z"), (201, "12 3", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    kept = {r["doc_id"]: r for r in language.known_documents(docs).collect()}
    assert kept[200]["lang"] == "de" and kept[200]["lang_pred"] == "z" and 201 not in kept and len(kept) == 61


def test_segmentation_paths_step_by_step():
    """Paths of many words at once are those of one word after the other, each edge drawn by its own hash."""
    own = segmentations.vocabulary(PIECES)
    texts, keys = ["the cat the hat", "", "naïve the 猫 caterpillar the the", "x"], np.array([3, 5, -7, 0])
    batch = segmentations.Batch(own, texts, keys)
    word = np.flatnonzero(np.arange(len(batch.word)) != 1)
    inside = np.where(word == 2, 1, 0)
    lane, edge = batch.paths(batch.text_of[word], word, inside, 2)
    want, lattice = [], batch.lattice
    for i, (w, within) in enumerate(zip(word.tolist(), inside.tolist())):
        base = batch.base[batch.word[w]]
        at = base + within
        while at < base + batch.own[batch.word[w]]:
            u = segmentations.uniform(keys[batch.text_of[w]], 2, batch.place[w] + at - base, 7)
            e = lattice.first[at]
            while u > lattice.share[e]:
                e += 1
            want.append((i, e))
            at = lattice.end[e]
    assert list(zip(lane.tolist(), edge.tolist())) == want


def test_best_of_groups_are_among_those_kept():
    rng = np.random.default_rng(1)
    group = np.sort(rng.integers(0, 300, 20_000))
    group = group[(group % 7 != 3) | (rng.random(len(group)) < 0.02)]  # some groups of one or none
    value = np.round(rng.normal(size=len(group)), 1)
    for wanted in (1, 2, 3, 5):
        kept = segmentations._best(value, group, 300, wanted)
        assert len(kept) < len(group) / 2 and np.all(np.diff(kept) > 0)
        for g in range(300):
            best = np.sort(value[group == g])[::-1][:wanted]
            assert np.array_equal(np.sort(value[kept][group[kept] == g])[::-1][:wanted], best)


def test_steps_of_the_trie():
    own = segmentations.vocabulary(PIECES)
    rng = np.random.default_rng(2)
    nodes, points = rng.integers(1, len(own.piece_at), 50_000), rng.integers(32, 0x250, 50_000)
    held = own.keys >= 0
    told = dict(zip(own.keys[held].tolist(), own.nodes[held].tolist()))
    assert sorted(told.values()) == list(range(1, len(own.piece_at)))
    want = [told.get(n << 21 | c, -1) for n, c in zip(nodes.tolist(), points.tolist())]
    assert own.child(nodes, points).tolist() == want
    real = np.array(list(told), np.int64)
    assert own.child(real >> 21, real & 0x1FFFFF).tolist() == list(told.values())


def test_row_sums_of_ids_are_those_of_reduceat():
    """To the last bit, without one strided reduction over the many ids that have few rows."""
    rng = np.random.default_rng(3)
    assert attention_lm.FEW == 8
    for size, top in ((4096, 49_000), (4096, 64), (30, 9), (1, 1)):
        index = np.minimum(rng.pareto(0.35, size).astype(np.int64), top)
        rows = rng.normal(size=(size, 48)).astype(np.float32)
        order = np.argsort(index, kind="stable")
        ids, start = np.unique(index[order], return_index=True)
        got, total = attention_lm._sum_by(index, rows)
        assert np.array_equal(got, ids) and np.array_equal(total, np.add.reduceat(rows[order], start, axis=0))
