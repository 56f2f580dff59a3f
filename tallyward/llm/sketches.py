"""Operator 9 [native]: bottom-k sketches of shingle hashes.

A document's shingles are its runs of five words (fewer words: all of them as one), each hashed to
64 bits; the sketch is the ``k`` smallest distinct hashes, kept as an ascending array of longs.
Sketches of parts merge to the sketch of the whole, and two of them estimate resemblance,
containment and the number of distinct shingles. Everything is made of Spark functions.

Each document is also compared with the next one by doc_id. Documents are dealt to ranges of
doc_id, once; the first row of each range also goes to the range before it (that of the first
range to the last), so that lead() within a range knows the next document.

Contract: null text counts as empty: no shingles, an empty fingerprint, like another empty one
(1.0) and unlike anything else (0.0). Equal doc_ids are ordered by text; a null doc_id sorts
first. A single document is its own next one. Empty table: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 64
SHINGLE = 5
RANGES = 128
BLANKS = "[\\x20\\x09-\\x0D]+"


def words(text: Column) -> Column:
    """The words of a text, without the empty strings at its ends."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """The 64-bit hash of every shingle, in order, repeated ones too."""
    hashed = F.transform(words(text), lambda w: F.xxhash64(w))
    return _windows(hashed, size)


def _windows(hashed: Column, size: int) -> Column:
    # hashed is bound once, as the only element of an array, instead of being written out in full.
    runs = F.transform(F.array(hashed), lambda h: F.when(
        F.size(h) >= size,
        F.transform(F.sequence(F.lit(1), F.size(h) - (size - 1)),
                    lambda i: F.xxhash64(*[F.get(h, i + (j - 1)) for j in range(size)]))
    ).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>")))
    return F.get(runs, 0)


def sketch(text: Column, k: int = K, size: int = SHINGLE) -> Column:
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(text, size))), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Share of the smallest hashes of both together that both have; 1.0 if neither has any."""
    both = merged(a, b, k)
    shared = F.size(F.array_intersect(F.array_intersect(both, a), b))
    return F.when(F.size(both) == 0, 1.0).otherwise(shared / F.size(both))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    share = (F.element_at(a, -1).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has: 1.0 if ``a`` has none."""
    union = distinct_shingles(merged(a, b, k), k)
    shared = resemblance(a, b, k) * union
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def merge_groups(sketched: DataFrame, keys: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """One sketch for each group of parts. The hashes are ranked, not collected: partial windows
    keep ``k`` rows of a group in each task before the shuffle."""
    rows = sketched.select(*keys, F.explode(column).alias("hash")).distinct()
    ranked = rows.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy("hash"))).filter(F.col("n") <= k)
    return ranked.groupBy(*keys).agg(F.sort_array(F.collect_list("hash")).alias(column))


def as_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def _range_of(key: Column, bounds: list[int]) -> Column:
    """Number of the range of a key, found by halving."""

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(key < bounds[mid], between(low, mid)).otherwise(between(mid + 1, high))

    return F.when(key.isNull(), 0).otherwise(between(0, len(bounds)))


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """doc_id, text, range r and g, dealt by r: in each range its documents and, with g true, the
    first of the next range. There are RANGES ranges, or as many as there are shuffle partitions."""
    ranges = ranges or max(RANGES, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    shares = [i / ranges for i in range(1, ranges)]
    found = rows.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0]
    rows = rows.withColumn("range", _range_of(F.col("doc_id"), sorted(set(found or []))))
    # The first doc_id of each range: one row for each range, at most ``ranges``.
    firsts = {r["range"]: r["first"] for r in rows.groupBy("range").agg(
        F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("first")).collect()}
    present = sorted(firsts)
    before = {r: present[i - 1] for i, r in enumerate(present)}  # the last range comes before the first
    ghost = F.lit(None).cast("int")
    for r in present:
        first = firsts[r]["doc_id"]
        same = F.col("doc_id").isNull() if first is None else F.col("doc_id") == first
        ghost = F.when((F.col("range") == r) & same, F.lit(before[r])).otherwise(ghost)
    own, copy = F.struct(F.col("range").alias("r"), F.lit(False).alias("g")), F.struct(ghost.alias("r"), F.lit(True).alias("g"))
    dealt = rows.select("doc_id", "text", F.explode(
        F.when(ghost.isNull(), F.array(own)).otherwise(F.array(own, copy))).alias("at"))
    return dealt.select("doc_id", "text", "at.r", "at.g").repartition("r")


def with_sketches(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, text and sketch of every document, next_text and next_sketch of the one after it."""
    order = Window.partitionBy("r").orderBy("g", F.asc_nulls_first("doc_id"), "text")
    made = with_next(docs).withColumn("sketch", sketch(F.col("text"), k))
    return made.select(
        "doc_id", "text", "sketch", "g", F.lead("text").over(order).alias("next_text"),
        F.lead("sketch").over(order).alias("next_sketch")).filter(~F.col("g")).drop("g")


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next,
    besides the estimates distinct_shingles and held_by_next (containment)."""
    rows = with_sketches(docs, k)
    n = F.char_length("text")
    cut = F.floor(n / 4).cast("int")
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn(
        "edited", F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut)))
    rows = rows.withColumn("edited_sketch", sketch(F.col("edited"), k))
    a, b, c = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(a).alias("fingerprint"), as_text(b).alias("edited_fingerprint"),
        resemblance(a, b, k).alias("near_edited"), resemblance(a, c, k).alias("near_next"),
        distinct_shingles(a, k).alias("distinct_shingles"), containment(a, c, k).alias("held_by_next"))
