"""Operators over a whole corpus, each against a plain model of it, and the pipeline."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tallyward.llm import exact_dedup, near_dups, quotes, sketches
from tallyward.llm.components import connected
from tallyward.llm.tables import ready, table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, n_shingles int, kept string, r int"


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))


def shingle_set(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def corpus():
    """Bases with edited and exact copies, a passage that many share, and odd rows."""
    rng = random.Random(5)
    vocabulary = ["w%d" % i for i in range(4000)] + ["Ä", "É", "b", "B"]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice((4, 30, 120, 500)))] for _ in range(25)]
    shared = [rng.choice(vocabulary) for _ in range(25)]
    texts = [" ".join(b) for b in base]
    for b in base[:8]:
        for _ in range(9):
            w = list(b)
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            texts.append((" " if rng.random() < 0.5 else "\n").join(w).upper() if rng.random() < 0.2 else " ".join(w))
    texts += [" ".join([rng.choice(vocabulary) for _ in range(rng.randint(3, 60))] + shared) for _ in range(60)]
    texts += ["", None, " \t ", "one", "ONE", "one two", "one  two", "É x", "é x", "a b c d e", "a b c d e", "z " * 30000]
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [(i, texts[j]) for i, j in enumerate(order)] + [(3, texts[order[3]]), (None, "no id"), (None, "no id"), (None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    ready(spark)
    rows = [(i, t, None, "s", None, "k", 1, "x", None) for i, t in corpus()]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_components(rows):
    """Smallest id reachable, by comparing all sets."""
    sets = defaultdict(set)
    for i, t in rows:
        if i is not None:
            sets[shingle_set(t)].add(i)
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def union(x, y):
        x, y = sorted((find(x), find(y)))
        root[y] = x

    held = [s for s in sets if s]
    for s in held:
        for i in sets[s]:
            union(i, min(sets[s]))
    for n, a in enumerate(held):
        for b in held[:n]:
            both = len(a & b)
            if 100 * both >= 75 * (len(a) + len(b) - both):
                union(min(sets[a]), min(sets[b]))
    return {i: find(i) if i is not None else None for i, _ in rows}


@pytest.mark.parametrize("counters", [1, 3, 1024])
def test_exact_groups(docs, empty, counters):
    groups = defaultdict(list)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    want = Counter()
    for t, members in groups.items():
        keep = max((i for i in members if i is not None), default=None)
        for i in members:
            want[i, keep, len(members), i == keep, hashlib.sha256(t.encode()).hexdigest()] += 1
    assert Counter(map(tuple, exact_dedup.exact_groups(docs, counters).collect())) == want
    kept = exact_dedup.kept_documents(docs, counters)
    assert kept.columns == docs.columns
    assert sorted((r["text"] or "").translate(LOWER) for r in kept.collect()) == sorted(groups)
    assert exact_dedup.exact_groups(empty).count() == 0


def test_misra_gries_keeps_frequent_digests():
    rng = random.Random(1)
    stream = ["hot"] * 400 + ["warm"] * 150 + ["d%d" % i for i in range(450)]
    rng.shuffle(stream)
    summary = exact_dedup.MisraGries(9)
    import pandas as pd

    for at in range(0, len(stream), 37):
        summary.add(pd.Series(stream[at:at + 37]).value_counts())
    assert len(summary.held) <= 9 and {"hot", "warm"} <= set(summary.held.index)
    assert 400 - 100 <= summary.held["hot"] <= 400


def test_near_duplicates(docs, empty):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    component = plain_components(rows)
    want = Counter((i, len(shingle_set(t)), component[i], i == component[i]) for i, t in rows)
    assert len(set(component.values())) < len(component) - 40
    assert Counter(map(tuple, near_dups.near_duplicates(docs).collect())) == want
    assert near_dups.near_duplicates(empty).count() == 0


def test_distance_and_keys(spark):
    rng = np.random.default_rng(4)
    a = rng.integers(0, 1 << 16, (200, near_dups.MINIMA)).astype(np.uint16)
    b = np.where(rng.random(a.shape) < rng.random((200, 1)), a, rng.integers(0, 1 << 16, a.shape)).astype(np.uint16)
    b[:50, :64] = np.where(rng.random((50, 64)) < 0.6, a[:50, :64], b[:50, :64])

    def rows(s, mark):
        lanes = np.hstack([np.ascontiguousarray(s[:, :64]).view(np.int64), near_dups.planes(s)])
        names = [*near_dups.LANES, *near_dups.PLANES]
        return spark.createDataFrame([(i, *map(int, r)) for i, r in enumerate(lanes)],
                                     ", ".join(["id long", *[f"{n} long" for n in names]])).select("id", *[F.col(n).alias(mark + n) for n in names])

    both = rows(a, "x_").join(rows(b, "y_"), "id")
    got = {r[0]: r[1] for r in both.select("id", near_dups.distance()).collect()}
    assert got == {i: int(((a[i] ^ b[i]) & 15 > 0).sum()) for i in range(200)}
    keys = lambda mark: near_dups._keys(both.select("id", *[F.col(mark + s).alias(s) for s in near_dups.LANES]))
    shared = keys("x_").intersect(keys("y_"))
    first = {tuple(r) for r in shared.groupBy("id").agg(F.min("key")).collect()}
    assert len(first) > 60
    # Pigeonhole: within 31 errors of 64 symbols a key is shared.
    errors = (a[:, :64] != b[:, :64]).sum(1)
    assert {i for i in range(200) if errors[i] <= 31} <= {i for i, _ in first}


def chained(n=90):
    """Texts near their neighbours or nearly so: within the signature limit of many, linked with few."""
    rng = random.Random(11)
    word = lambda: "v%d" % rng.randrange(10**6)
    base = [word() for _ in range(200)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.choice((2, 4, 5, 6, 7))):
            w[rng.randrange(200)] = word()
        rows.append((i, " ".join(w)))
    other = " ".join(word() for _ in range(60))
    # An id with two texts joins the groups of both; one with the same text twice changes nothing.
    return rows + [(n, other), (n, rows[3][1]), (n + 1, other + " end"), (n + 2, other), (n + 2, other), (n + 3, rows[5][1] + " x")]


@pytest.mark.parametrize("part, block", [(2048, 256), (16, 8)])
def test_near_duplicates_of_mixed_keys(spark, monkeypatch, part, block):
    rows = chained()
    component = plain_components(rows)
    assert 5 < len(set(component.values())) < 60
    monkeypatch.setattr(near_dups, "PART", part)
    monkeypatch.setattr(near_dups, "BLOCK", block)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dups.near_duplicates(docs).collect()
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == Counter((i, component[i]) for i, _ in rows)


def test_joining_links_equal_plain_ones():
    rng = np.random.default_rng(2)
    base = rng.choice(10**6, 400, replace=False).astype(np.uint64)
    sets = [np.unique(np.where(rng.random(400) < rng.choice([0.03, 0.12, 0.15]), rng.integers(0, 10**9, 400).astype(np.uint64), base)) for _ in range(40)]
    left, right = np.arange(25), np.arange(15, 40)
    got = near_dups._shared(sets, left, right, 64)
    assert all(got[i, j - 15] == len(np.intersect1d(sets[i], sets[j])) for i in left for j in right if i != j)
    links = {(i, j) for i in left for j in right if i != j and near_dups.near(sets[i], sets[j])}
    root = list(range(40))
    for found in (links, near_dups.joining(sets, np.arange(40), np.arange(40), left, right)):
        root = list(range(40))
        for i, j in found:
            low, high = sorted((root[i], root[j]))
            root = [low if r == high else r for r in root]
        want = root if found is links else want
    assert root == want and len(set(root)) > 1 and len(links) > 40


@pytest.mark.parametrize("local", [0, 1000])
def test_components(spark, local):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 140)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    root = {x: x for e in links for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(root[a], root[b])
            changed |= root[a] != m or root[b] != m
            root[a] = root[b] = m
    got = dict(map(tuple, connected(spark.createDataFrame(links, "a long, b long"), local=local).collect()))
    assert all(got.get(x, x) == m for x, m in root.items())


def plain_sketch(text, k=sketches.K):
    hashed = [xxhash.xxh64_intdigest(w.encode(), 42) for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    hashed = [h - (1 << 64) if h >> 63 else h for h in hashed]

    def chain(run):
        seed = 42
        for h in run:  # longs are hashed one after the other, each with the hash before it as seed
            seed = xxhash.xxh64_intdigest((h % (1 << 64)).to_bytes(8, "little"), seed)
        return seed - (1 << 64) if seed >> 63 else seed

    runs = [hashed[i:i + 5] for i in range(max(1, len(hashed) - 4))] if hashed else []
    return sorted({chain(r) for r in runs})[:k]


def like(a, b, k=sketches.K):
    both = sorted(set(a) | set(b))[:k]
    return 1.0 if not both else len(set(both) & set(a) & set(b)) / len(both)


def test_fingerprints(docs, empty):
    rows = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "") for r in docs.collect()))
    text_of = lambda s: "".join(f"{h % (1 << 64):016x}" for h in s)
    want = Counter()
    for n, (known, i, t) in enumerate(rows):
        after = rows[(n + 1) % len(rows)][2]
        cut = len(t) // 4
        edited = t[:len(t) - cut] + after[:cut]
        a, b, c = plain_sketch(t), plain_sketch(edited), plain_sketch(after)
        want[i if known else None, len(t), hashlib.sha256(edited.encode()).hexdigest(), text_of(a), text_of(b), like(a, b), like(a, c)] += 1
    got = sketches.fingerprints(docs).drop("distinct_shingles", "held_by_next")
    assert Counter(map(tuple, got.collect())) == want
    assert sketches.fingerprints(empty).count() == 0


def test_sketches_merge_and_estimate(spark):
    rng = random.Random(8)
    text = " ".join("v%d" % rng.randrange(3000) for _ in range(3000))
    half = text[:text.index(" ", len(text) // 2)]
    df = spark.createDataFrame([("a", text, half), ("b", "x", "x")], "id string, text string, half string")
    df = df.withColumn("s", sketches.sketch(F.col("text"))).withColumn("h", sketches.sketch(F.col("half")))
    r = df.filter("id = 'a'").select(
        sketches.distinct_shingles(F.col("s")), sketches.containment(F.col("h"), F.col("s")),
        sketches.containment(F.col("s"), F.col("h")), sketches.resemblance(F.col("s"), F.col("h"))).first()
    assert abs(r[0] - len(shingle_set(text))) < 0.5 * len(shingle_set(text))
    assert r[1] > 0.75 and abs(r[2] - 0.5) < 0.25 and abs(r[3] - 0.5) < 0.25
    parts = df.select("id", F.col("s").alias("sketch")).union(df.select("id", "h"))
    merged = {x["id"]: x["sketch"] for x in sketches.merge_groups(parts, ["id"]).collect()}
    assert merged == {x["id"]: x["m"] for x in df.select("id", sketches.merged(F.col("s"), F.col("h")).alias("m")).collect()}


def test_quotes(spark):
    ready(spark)
    a = "First thing.\nSecond  THING.\n\nthird"
    rows = [
        ("t", "1", 1, a), ("t", "2", 2, "On Monday X wrote:\n> first thing.\n>   second thing.\nMy answer"),
        ("t", "3", 3, "> My answer\n>> third\n> > First thing.\nfine\n> never said\nX wrote:\nend"),
        ("t", "4", 4, "> fine\n\n\n"), ("t", "5", 5, "> end"), ("u", "6", 6, "> first thing."), ("t", "0", 0, "> first thing."),
        (None, "7", 1, "own"), (None, "8", 2, "> own"), ("t", "9", 9, None), ("t", None, 9, "x"), ("t", "1", 1, a)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "thread string, message string, sent long, text string, root string")
    got = {r["message"]: (r["parent"], r["root"], r["depth"], r["max_level"], r["linked"], r["text"]) for r in quotes.conversations(df).collect()}
    assert got == {
        "1": (None, "1", 0, 0, 0, a), "2": ("1", "1", 1, 1, 2, "My answer"),
        "3": ("2", "1", 2, 2, 3, "fine\nX wrote:\nend"), "4": ("3", "1", 3, 1, 1, ""), "5": ("3", "1", 3, 1, 1, ""),
        "6": (None, "6", 0, 1, 0, ""), "0": (None, "0", 0, 1, 0, ""), "7": (None, "7", 0, 0, 0, "own"),
        "8": ("7", "7", 1, 1, 1, ""), "9": (None, "9", 0, 0, 0, "")}
    assert quotes.conversations(df.limit(0)).count() == 0


def test_quotes_link_the_latest_holder(spark):
    ready(spark)
    texts = {1: ["A", "yes", "B", "yes", "C"], 2: ["A", "", "B", None, " ", "C", "yes", "yes", "D"], 3: ["", "a", "", "b"],
             4: ["yes", "no"] * 150}
    rows = [(c, t, "user", x) for c, own in texts.items() for t, x in enumerate(own)]
    mails = quotes.replies_with_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r["message"]: (r["parent"], r["root"], r["depth"], r["max_level"]) for r in quotes.conversations(mails).collect()}
    assert got == {f"{c}:{t}": (f"{c}:{t - 1}" if t else None, f"{c}:0", t, min(t, 2)) for c, t, *_ in rows}


def test_pipeline_stages(spark, docs, empty, smoke_dir):
    rows = [(r["doc_id"], r["text"]) for r in docs.filter("doc_id is not null").collect()]
    labelled = docs.withColumn("lang", F.lit("en"))
    out = labelled
    for name, stage in corpus_pipeline.STAGES:
        before, out = out, stage(spark, out, "")
        if name != "packing":
            assert out.columns == docs.columns
        if name == "language":
            assert {r["text"] for r in out.collect()} == {r["text"] for r in docs.collect() if re.search(r"[^\W\d_]", r["text"] or "")}
        if name == "near_dedup":
            held = [(r["doc_id"], r["text"]) for r in before.collect()]
            component = plain_components(held)
            assert sorted(r["doc_id"] for r in out.filter("doc_id is not null").collect()) == sorted(
                {i for i, c in component.items() if i is not None and i == c})
            kept = {r["doc_id"] for r in out.collect()}
        if name == "packing":
            assert {r["doc_id"] for r in out.collect()} == kept
    assert len(kept) < len(rows)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0


def test_language_stage_keeps_unlabelled_documents(spark, docs):
    assert docs.filter("lang is not null").count() == 0
    want = Counter(r["text"] for r in docs.collect() if re.search(r"[^\W\d_]", r["text"] or ""))
    named = docs.withColumn("lang", F.lit("und"))  # a label that is called like no language
    for rows in (docs, docs.withColumn("doc_id", F.lit(None).cast("long")).withColumn("lang", F.lit("en")), named):
        assert Counter(r["text"] for r in corpus_pipeline.language_stage(spark, rows, "").collect()) == want


def test_pipeline_run(spark, smoke_dir):
    pieces = corpus_pipeline.run(spark, smoke_dir)
    documents = table(spark, smoke_dir, "documents")
    assert 0 < pieces.select("doc_id").distinct().count() < documents.count()
