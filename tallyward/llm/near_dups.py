"""Operator 8: near-duplicates by a multi-index Hamming join over b-bit MinHash signatures.

Index. The first SYMBOLS = 64 minima over a document's 5-word shingles give symbols of 16 bits. Two
documents of resemblance J differ in about (1 - J) * SYMBOLS of them; at J = 0.75 in more than 31
once in 1e5 cases, and less often above. Pigeonhole: with at most 31 errors, one of 16 chunks of 4
symbols has at most one. So each chunk gives four keys, one for each symbol that may be wrong, made
of the other three: all pairs within 31 errors share a key.

Distance. All MINIMA = 512 minima give symbols of 4 bits, kept as bit planes, so that the number of
symbols that differ is a few bit counts. At J = 0.75 it is above LIMIT = 162 (4.4 deviations above
its mean of 120) five times in 1e6 cases; pairs below J = 0.66 are mostly above it. Links are
confirmed on the full shingle sets, from whole texts.

Groups of copies never become pairs. Texts with the same shingle set form one class. Every class
is first compared with one centre: of the smallest classes of its keys, the one that it shares most
keys with. Confirmed links give components. Members of keys that still hold several components are
put into blocks of like texts, of BLOCK members and SETS shingles at most on average. Where members
of different components share a key and are within LIMIT, their two blocks meet: a row for two
blocks, however many such pairs they hold. Blocks that meet are compared on their full shingle sets
at once, every member with every other, by products of 0/1 matrices; of the links found only those
come out that join components. So no row exists for a pair that is not a link, hot keys are cut into
parts and hot groups into blocks, each link between different components is found, and no cap is set.

Contract: null counts as empty; a document without words has an empty set and no links. A doc_id
stands for one document: rows that repeat it are linked by any of their texts and come out once
each. Rows with a null doc_id are returned with a null component, kept. Empty table: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.components import connected
from tallyward.llm.tables import slices, stored
from tallyward.llm.word_hashes import BASE, mix, words

SHINGLE = 5
SHARE = 75  # link where 100 * intersection >= SHARE * union
SYMBOLS, CHUNK = 64, 4
MINIMA, BITS, LIMIT = 512, 4, 162
LANES = [f"s{i}" for i in range(SYMBOLS // 4)]  # four symbols to a long: what keys are made of
PLANES = [f"p{i}" for i in range(MINIMA // 64 * BITS)]  # BITS longs for every 64 symbols, a long for each bit
WORDS_OF_FILTER = 1 << 18
PART = 2048  # members of a key in a part of it
BLOCK, SETS = 256, 1 << 19  # members of a block, shingles of its sets

def shingles(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of the texts, in order, and the number of each text.

    Texts of fewer than ``size`` words have one, of all their words."""
    word, counts = words(texts)
    upto = np.cumsum(counts)
    # Hash of each run of `size` words; runs that cross a text's end are left out.
    n = len(word)
    run = np.zeros(n, np.uint64)
    for j in range(size):
        run[:max(0, n - j)] = run[:max(0, n - j)] * np.uint64(BASE) + word[j:]
    own = np.repeat(upto, counts) - np.arange(n)  # words left in the text
    whole = own >= size
    short = np.flatnonzero((counts > 0) & (counts < size))
    for i in short.tolist():
        at = upto[i] - counts[i]
        h = np.uint64(counts[i])
        for w in word[at:upto[i]]:
            h = h * np.uint64(BASE) + w
        run[at] = h
        whole[at] = True
    per = np.maximum(counts - (size - 1), (counts > 0).astype(np.int64))
    return mix(run[whole]), per


_FACTORS = (mix(np.arange(1, MINIMA + 1, dtype=np.uint64)) | np.uint64(1)).astype(np.uint32)
_SHIFTS = mix(np.arange(1001, MINIMA + 1001, dtype=np.uint64)).astype(np.uint32)


def signatures(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """16-bit symbols, a row for each text with shingles and a column for each minimum."""
    begin = np.cumsum(counts) - counts
    begin = begin[counts > 0]
    out = np.empty((MINIMA, len(begin)), np.uint16)
    if not len(begin):
        return out.T
    short = (values >> np.uint64(32)).astype(np.uint32)
    room = np.empty_like(short)
    for k in range(MINIMA):
        np.bitwise_xor(short, _SHIFTS[k], out=room)
        np.multiply(room, _FACTORS[k], out=room)
        out[k] = mix(np.minimum.reduceat(room, begin).astype(np.uint64)) >> np.uint64(48)
    return np.ascontiguousarray(out.T)


def planes(symbols: np.ndarray) -> np.ndarray:
    """PLANES: the low BITS bits of every 64 symbols, a long for each bit."""
    made = []
    for at in range(0, MINIMA, 64):
        part = symbols[:, at:at + 64]
        made += [np.packbits((part >> np.uint16(i)).astype(np.uint8) & 1, axis=1, bitorder="little").view(np.int64)
                 for i in range(BITS)]
    return np.hstack(made)


def _sketch(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_id and the signature of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts):
                with np.errstate(over="ignore"):
                    values, counts = shingles(texts[a:b])
                    ends = np.cumsum(counts)
                    sizes, sets = [], []
                    for end, n in zip(ends.tolist(), counts.tolist()):
                        own = np.unique(values[end - n:end])
                        sizes.append(len(own))
                        sets.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if n else None)
                    lanes = np.zeros((b - a, len(LANES) + len(PLANES)), np.int64)
                    symbols = signatures(values, counts)
                    lanes[counts > 0] = np.hstack([np.ascontiguousarray(symbols[:, :SYMBOLS]).view(np.int64), planes(symbols)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary()),
                     *[pa.array(lanes[:, i]) for i in range(lanes.shape[1])]],
                    names=["doc_id", "n_shingles", "set_id", *LANES, *PLANES])

    ddl = "doc_id long, n_shingles long, set_id binary, " + ", ".join(f"{s} long" for s in [*LANES, *PLANES])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, ddl)


def _keys(classes: DataFrame) -> DataFrame:
    """id and key: SYMBOLS keys for each class, each naming its chunk, the symbol left out and
    the other three symbols."""
    made = []
    for i, lane in enumerate(LANES):
        for out in range(CHUNK):
            low = F.col(lane).bitwiseAND((1 << 16 * out) - 1)
            high = F.shiftrightunsigned(F.shiftrightunsigned(lane, 16 * out), 16)
            kept = low.bitwiseOR(F.shiftleft(high, 16 * out)) if out < 3 else low
            made.append(kept.bitwiseOR(F.lit((i * CHUNK + out) << 48)))
    return classes.select("id", F.explode(F.array(*made)).alias("key"))


def _apart(planes_: list[str]) -> Column:
    """Bit i: the symbols i of two signatures, x_ and y_, differ."""
    apart = F.lit(0).cast("long")
    for p in planes_:
        apart = apart.bitwiseOR(F.col(f"x_{p}").bitwiseXOR(F.col(f"y_{p}")))
    return apart


def distance() -> Column:
    """Symbols of BITS bits that differ between the signatures x_ and y_."""
    return sum((F.bit_count(_apart(PLANES[at:at + BITS])) for at in range(BITS, len(PLANES), BITS)),
               F.bit_count(_apart(PLANES[:BITS])))


def _size_fits(a: Column, b: Column) -> Column:
    """Sets of resemblance SHARE / 100 differ no more in size."""
    return (100 * F.least(a, b)) >= (SHARE * F.greatest(a, b))


def _signed(classes: DataFrame, id_: str, mark: str, *columns: str) -> DataFrame:
    """The classes with id ``id_`` and their sizes and signatures as columns marked x_ or y_."""
    return classes.select(F.col("id").alias(id_), *columns, *[F.col(c).alias(mark + c) for c in ["n_shingles", *PLANES]])


def _within(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes fit and whose signatures are within LIMIT."""
    both = pairs.join(_signed(classes, "a", "x_"), "a").join(_signed(classes, "b", "y_"), "b")
    return both.filter(_size_fits(F.col("x_n_shingles"), F.col("y_n_shingles")) & (distance() <= LIMIT)).select("a", "b")


def _wanted(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Fewer texts to shuffle: id and text of documents whose bit is set in a map of WORDS_OF_FILTER
    longs (4 MB, its bound) made of ``ids``. Others may pass; the joins that follow are exact."""
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    place = F.xxhash64("id")
    word = F.pmod(place, F.lit(WORDS_OF_FILTER)).cast("int")
    bit = F.shiftrightunsigned(place, 58).cast("int")
    bits = ids.select(word.alias("word"), F.expr("shiftleft(1L, cast(shiftrightunsigned(xxhash64(id), 58) as int))").alias("bit"))
    map_ = bits.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    near = texts.withColumn("word", word).withColumn("bit", bit).join(F.broadcast(map_), "word")
    return near.filter(F.expr("(shiftrightunsigned(bits, bit) & 1) = 1")).select("id", "text")


def _confirm(pairs: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    """The pairs (a, b), told apart by linked: whether the full sets are near."""
    pairs = pairs.select("a", "b")
    texts = _wanted(docs, pairs.select(F.col("a").alias("id")).distinct().union(pairs.select(F.col("b").alias("id")).distinct()))
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").join(
        texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, ta, tb = (batch.column(c).to_pylist() for c in ("a", "b", "ta", "tb"))
            sets = _sets(dict.fromkeys(zip(a + b, ta + tb)))
            linked = [near(sets[x], sets[y]) for x, y in zip(zip(a, ta), zip(b, tb))]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())],
                                             names=["a", "b", "linked"])

    return stored(both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long, linked boolean"), name)


def _sets(members: Iterable[tuple[int, str]]) -> dict[tuple[int, str], np.ndarray]:
    """The shingle set of each (id, text): an id may have several texts."""
    out = {}
    keys = list(members)
    values = [text for _, text in keys]
    for a, b in slices(values):
        with np.errstate(over="ignore"):
            hashes, counts = shingles(values[a:b])
        ends = np.cumsum(counts)
        for key, end, n in zip(keys[a:b], ends.tolist(), counts.tolist()):
            out[key] = np.unique(hashes[end - n:end])
    return out


def near(a: np.ndarray, b: np.ndarray) -> bool:
    if 100 * min(len(a), len(b)) < SHARE * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= SHARE * (len(a) + len(b) - both)


def _shared(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, width: int = 1 << 14) -> np.ndarray:
    """Size of the intersection of each set of ``left`` with each other one of ``right`` (numbers of sets)."""
    sizes = np.array([len(x) for x in sets])
    _, column, found = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # Only shingles of several sets count; they are numbered without gaps.
    kept = found > 1
    number = np.cumsum(kept) - 1
    row = np.repeat(np.arange(len(sets)), sizes)[kept[column]]
    column = number[column[kept[column]]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(right)))
    for at in range(0, int(kept.sum()), width):
        lo, hi = np.searchsorted(column, [at, at + width])
        has = np.zeros((len(sets), width), np.float32)
        has[row[lo:hi], column[lo:hi] - at] = 1
        out += has[left] @ has[right].T
    return out


def joining(sets: list[np.ndarray], ids: np.ndarray, components: np.ndarray, left: np.ndarray,
            right: np.ndarray) -> list[tuple[int, int]]:
    """Links between ``left`` and ``right`` that join different components: a spanning forest of them."""
    sizes = np.array([len(x) for x in sets])
    a, b = sizes[left][:, None], sizes[right][None, :]
    wanted = (components[left][:, None] != components[right][None, :]) & (100 * np.minimum(a, b) >= SHARE * np.maximum(a, b))
    if not wanted.any():
        return []
    both = _shared(sets, left, right)
    i, j = np.nonzero(wanted & (100 * both >= SHARE * (a + b - both)))
    if not len(i):
        return []
    ends = np.stack([components[left[i]], components[right[j]]], axis=1)
    _, one = np.unique(ends, axis=0, return_index=True)
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    out = []
    for k in one.tolist():
        u, v = find(int(ends[k, 0])), find(int(ends[k, 1]))
        if u != v:
            root[u] = v
            out.append((int(ids[left[i[k]]]), int(ids[right[j[k]]])))
    return out


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin in sorted columns, and the end."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), n)


def _meet(group: pa.Table) -> pa.Table:
    """Blocks that meet, of members (key, p, q, part, ...): parts p and q of a key are compared, those
    that are not of the key's component ``low`` with all of another component."""
    group = group.sort_by([(c, "ascending") for c in ("key", "p", "q", "part")])
    get = lambda c: group.column(c).to_numpy()
    key, p, q, part, component, block, size = (get(c) for c in ("key", "p", "q", "part", "component", "block", "n_shingles"))
    signed = [get(c).view(np.uint64) for c in PLANES]
    own = _runs(key, p, q, part)
    begin, stop = (np.repeat(x, np.diff(own)) for x in (own[:-1], own[1:]))  # of the part itself
    whole = _runs(key, p, q)
    first, last = (np.repeat(x, np.diff(whole)) for x in (whole[:-1], whole[1:]))
    split = p != q  # then the other part: what lies before this one or behind it
    y0 = np.where(split & (begin == first), stop, first)
    y1 = np.where(split & (begin != first), begin, last)
    x = np.flatnonzero((component != get("low")) & (y1 > y0))
    upto = np.cumsum(y1[x] - y0[x])
    numbers, place = np.unique(block, return_inverse=True)
    told = np.empty(0, np.int64)
    at = 0
    while at < len(x):
        done = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, done + (1 << 19), "right")))
        rows = x[at:end]
        n = y1[rows] - y0[rows]
        i = np.repeat(rows, n)
        j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(y0[rows], n)
        code = np.minimum(place[i], place[j]) * len(numbers) + np.maximum(place[i], place[j])
        ok = (component[i] != component[j]) & ~np.isin(code, told)
        ok &= 100 * np.minimum(size[i], size[j]) >= SHARE * np.maximum(size[i], size[j])
        i, j, code = i[ok], j[ok], code[ok]
        apart = np.zeros(len(i), np.int64)
        for b in range(0, len(PLANES), BITS):
            differ = np.zeros(len(i), np.uint64)
            for c in signed[b:b + BITS]:
                differ |= c[i] ^ c[j]
            apart += np.bitwise_count(differ)
        told = np.union1d(told, code[apart <= LIMIT])
        at = end
    return pa.table({"p": pa.array(numbers[told // len(numbers)], pa.int64()), "q": pa.array(numbers[told % len(numbers)], pa.int64())})


def _compare(group: pa.Table) -> pa.Table:
    """Links (a, b) of members (p, q, block, id, component, text) of blocks p and q that meet."""
    group = group.sort_by([("p", "ascending"), ("q", "ascending")])
    p, q, block, ids, components = (group.column(c).to_numpy() for c in ("p", "q", "block", "id", "component"))
    members = list(zip(ids.tolist(), group.column("text").to_pylist()))
    sets = _sets(dict.fromkeys(members))
    bounds = _runs(p, q).tolist()
    found = []
    for lo, hi in zip(bounds, bounds[1:]):
        at = np.arange(hi - lo)
        left, right = at[block[lo:hi] == p[lo]], at[block[lo:hi] == q[lo]]
        found += joining([sets[m] for m in members[lo:hi]], ids[lo:hi], components[lo:hi], left, right)
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def _links_of_blocks(members: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links between components of the members (key, centre, id, component, low, n) of mixed keys."""
    sizes = classes.groupBy("id").agg(F.max("n_shingles").alias("n_shingles"))
    homes = members.groupBy("id").agg(F.min("centre").alias("home"), F.first("component").alias("component")).join(sizes, "id")
    parts = homes.groupBy("home").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n_shingles") / SETS)).alias("parts"))
    placed = stored(homes.join(parts, "home").select(
        "id", "component", F.xxhash64("home", F.pmod(F.xxhash64("id"), "parts")).alias("block"),
        F.col("n_shingles").alias("room")), "near-blocks")

    cut = members.withColumn("parts", F.ceil(F.col("n") / PART)).withColumn("part", F.pmod(F.xxhash64("id"), "parts"))
    rows = cut.agg(F.sum("parts")).first()[0] or 0
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).select(
        "key", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "part", "id", "low")
    signed = cut.join(placed.select("id", "component", "block"), "id").join(classes.select("id", "n_shingles", *PLANES), "id")
    bucket = F.pmod(F.xxhash64("key", "p", "q"), F.lit(rows // (2 * PART) + 1))
    meeting = stored(signed.groupBy(bucket).applyInArrow(_meet, "p long, q long").distinct(), "near-meetings")

    sides = meeting.select("p", "q", F.explode(F.array_distinct(F.array("p", "q"))).alias("block"))
    room = sides.join(placed.groupBy("block").agg(F.sum("room").alias("room")), "block").agg(F.sum("room")).first()[0] or 0
    whole = placed.join(sides.select("block").distinct(), "block", "left_semi").select("id", "block", "component")
    texts = _wanted(docs, whole.select("id")).join(whole, "id")
    bucket = F.pmod(F.xxhash64("p", "q"), F.lit(room // SETS + 1))
    return sides.join(texts, "block").groupBy(bucket).applyInArrow(_compare, "a long, b long")


def linked_classes(classes: DataFrame, docs: DataFrame, known: DataFrame) -> DataFrame:
    """id and component of every class that has a link. ``known`` are links (a, b) given beforehand."""
    keys = _keys(classes)
    shared = keys.groupBy("key").agg(F.min("id").alias("centre"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    keys = stored(keys.join(shared.select("key", "centre"), "key"), "near-keys")

    # One centre for each class.
    stars = keys.filter("id <> centre").groupBy("id", "centre").agg(F.count(F.lit(1)).alias("n"))
    best = stars.groupBy(F.col("id").alias("a")).agg(F.max(F.struct("n", (-F.col("centre")).alias("b"))).alias("best"))
    best = _within(best.select("a", (-F.col("best.b")).alias("b")), classes)
    links = _confirm(best, docs, "near-links").filter("linked").select("a", "b").unionByName(known)
    labels = connected(links)

    # Keys that still hold several components.
    named = keys.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                     F.count(F.lit(1)).alias("n")).filter("low <> high")
    members = stored(named.join(mixed.select("key", "low", "n"), "key"), "near-members")
    return connected(links.unionByName(_links_of_blocks(members, classes, docs)))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    rows = stored(_sketch(docs), "near-rows")
    known = rows.filter("doc_id is not null and set_id is not null")
    classes = stored(known.groupBy("set_id").agg(
        F.min("doc_id").alias("id"), F.first("n_shingles").alias("n_shingles"),
        *[F.first(s).alias(s) for s in [*LANES, *PLANES]]), "near-classes")
    # A doc_id with several sets links the classes that hold them.
    several = known.groupBy("doc_id").agg(F.min("set_id").alias("low"), F.max("set_id").alias("high")).filter("low <> high")
    same = known.join(several.select("doc_id"), "doc_id", "left_semi").join(classes.select("set_id", "id"), "set_id")
    labels = linked_classes(classes.drop("set_id"), docs, same.select(F.col("doc_id").alias("a"), F.col("id").alias("b")).distinct())
    placed = classes.select("set_id", "id").join(labels, "id", "left").select(
        "set_id", F.coalesce("component", "id").alias("component"))
    joined = rows.select("doc_id", "n_shingles", "set_id").join(placed, "set_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.least(F.coalesce("component", "doc_id"), "doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
