"""Operator 12 against a plain trie of tuples, and against its SQL."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from tallyward.llm import prefix_trie
from tallyward.llm.queries import ORACLES
from tallyward.llm.tables import ready, table

SCHEMA = "conv_id long, turn long, role string, text string, depth string, part string, place string"


def conversations(rows):
    held = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            held[c].append((turn is not None, turn or 0, hashlib.sha256(
                f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest(), role or "", text or ""))
    return {c: [x[3:] for x in sorted(own)] for c, own in held.items()}


def plain(made):
    """Rows of the trie, from every conversation's list of turns."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    rows = {}
    for node in sorted(members, key=len, reverse=True):
        children = [n for n in rows if n[:-1] == node and len(n) == len(node) + 1]
        n = len(members[node])
        rows[node] = (
            min(members[node]), len(node), min(members[node[:-1]]) if node else None, n, len(children),
            sum(rows[k][5] for k in children) or 1,
            sum(rows[k][6] for k in children) + (n - 1) * (len(node[-1][1].encode()) if node else 0),
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
    return Counter(rows.values())


def rebuilt(convs):
    made = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        donor = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        made[c] = convs.get(donor, [])[:h] + own[h:]
    return made


def noise(n, seed, depth=12):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rng.choice([0, 1, 2, 3, depth])):
            rows.append((c * 3 % n - 4, turn, rng.choice(["user", "bot", None]), rng.choice(["yes", "no é", "", None])))
    return rows


HOT = [(7, t, "user", f"turn {t}") for t in range(300)] + [(11, t, "user", f"turn {t}") for t in range(250)]
CASES = {
    "odd": [(1, None, "user", None), (1, 0, None, "x"), (1, 0, None, "x"), (2, 5, "user", ""), (None, 1, "user", "lost"), (2, 5, "user", "tie"),
            (10, 1, "u", "a"), (12, 1, "u", "a"), (-3, 1, "u", "a"), (3, 0, "", "y" * 40000)],
    "noise": noise(80, 1),
    "hot first turn": [(c, t, "user", "hello" if t == 0 else f"{c % 50}") for c in range(200) for t in range(2)],
    "long": HOT + [(900 + i, t, "user", "same") for i in range(40) for t in range(3)],
    "nested": [(c, t, "u", "x") for c in range(7) for t in range(c)],
}


def rows_of(df):
    return Counter(map(tuple, df.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()))


@pytest.mark.parametrize("case", CASES)
def test_against_plain_trie(spark, case, monkeypatch):
    ready(spark)
    monkeypatch.setattr(prefix_trie, "SLICE", 7)
    rows = CASES[case]
    turns = spark.createDataFrame([(*r, "clash", None, "c") for r in rows], SCHEMA).repartition(3)
    convs = conversations(rows)
    assert rows_of(prefix_trie.conversation_trie(turns)) == plain(convs)
    assert rows_of(prefix_trie.rebuilt_trie(turns)) == plain(rebuilt(convs))


def test_empty_table_and_types(spark):
    ready(spark)
    got = prefix_trie.rebuilt_trie(spark.createDataFrame([], SCHEMA))
    assert got.count() == 0
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [
        (c, "bigint") for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    ] + [("ends_sha256", "string")]


def test_against_sql(spark, smoke_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{smoke_dir}/conversations.parquet'")
    want = Counter(con.sql(ORACLES["op12_prefix_trie"]).fetchall())
    assert rows_of(prefix_trie.rebuilt_trie(table(spark, smoke_dir, "conversations"))) == want
