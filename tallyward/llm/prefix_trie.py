"""Operator 12: prefix trie of conversations by truncation peeling.

A conversation is the sequence of its turns; its first d turns are a node of depth d, named by a
hash of them. Nodes are peeled off from the deepest ends: what is known of a node's subtree is
merged with the conversations that end there, then the last turn is stripped and nodes with equal
remaining turns are grouped. One turn at a time would take as many jobs as the longest
conversation has turns, so a step strips a whole run: the turns between a node and the next
shallower one where another branch joins or a conversation ends. Within a run the members are the
same, so all its nodes follow from its deepest one. Members, their smallest id and endings are
aggregated in the very grouping that finds the nodes. Runs of one member need no step, the rest as
many as there are branchings above each other.

No conversation is gathered. A turn's place is its rank: turns are range-partitioned, ranked within
their partition, and the ranks of earlier partitions added. The hash of d turns is the exclusive or
of d hashes of (place, role, text), and bytes are a running sum; both are carried over slices of
SLICE turns, so one endless conversation is spread like many short ones. The list of a node's ended
conversations is cut into pieces by range partitioning; only pieces at the edges of partitions meet
again, streamed in order through one digest.

Contract: null role or text counts as empty; null turns come first; turns of equal number are
ordered by the SHA-256 of role and text. Rows without conv_id belong to no conversation and are left
out. Extra columns are dropped. An empty table has no nodes, not even a root. Node names are 120 bits of SHA-256 hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.tables import stored

SLICE = 4096
PIECE_IDS = 50_000
NAME = ("p", "q")  # the two halves of a node's name
PARENT = ("above_p", "above_q")
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def ranked(turns: DataFrame) -> DataFrame:
    """Stored: conv_id, place (from 1), p and q (a hash of role and text) and size (bytes of text)."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("size"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]
    half = [F.conv(F.substring("digest", start, 15), 16, 10).cast("long").alias(c) for start, c in ((1, "p"), (16, "q"))]
    ordered = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", *half, "size", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")), "trie-ordered")
    pieces = ordered.groupBy("conv_id", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("conv_id", "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first") + 1).alias("shift"))
    return stored(ordered.join(pieces, ["conv_id", "part"]).select(
        "conv_id", (F.col("row") + F.col("shift")).alias("place"), "p", "q", "size"), "trie-ranked")


def rebuilt(turns: DataFrame, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations as the contract wants them: (conv_id, n) for each, and ranked turns of all. Of
    ``turns`` the first h go, and the first h of the conversation conv_id - conv_id % 5 come; h is
    crc32(conv_id) % most."""
    whole = turns.groupBy("conv_id").agg(F.max("place").alias("n"))
    asked = whole.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % 5).alias("donor"),
                         (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h"))
    lengths = whole.select(F.col("conv_id").alias("donor"), F.col("n").alias("held"))
    asked = asked.join(lengths, "donor", "left").select(
        "conv_id", "donor", "h", F.least("h", F.coalesce("held", F.lit(0))).alias("got"), "n")
    asked = stored(asked, "trie-asked")
    heads = turns.filter(F.col("place") < most).withColumnRenamed("conv_id", "donor")
    given = asked.select("conv_id", "donor", "h").join(heads, "donor").filter("place <= h").select(
        "conv_id", "place", "p", "q", "size")
    # A long conversation's turns meet their one row slice by slice.
    slices = asked.withColumn("slice", F.explode(F.sequence(F.lit(0), F.expr(f"n div {SLICE}"))))
    own = turns.withColumn("slice", F.expr(f"place div {SLICE}")).join(
        slices.select("conv_id", "slice", "h", "got"), ["conv_id", "slice"]).filter("place > h").select(
        "conv_id", (F.col("place") - F.col("h") + F.col("got")).alias("place"), "p", "q", "size")
    kept = asked.select("conv_id", (F.greatest(F.col("n") - F.col("h"), F.lit(0)) + F.col("got")).alias("n"))
    return kept, given.unionByName(own)


def paths(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """Stored: for every prefix of every conversation (depth 0 too) its name and that of the prefix
    before it, bytes before its last turn and of that turn, and whether the conversation ends there."""
    mixed = [F.expr(f"xxhash64({i}, place, p, q)").alias(c) for i, c in enumerate(NAME)]
    rows = turns.select("conv_id", "place", *mixed, "size", F.expr(f"place div {SLICE}").alias("slice"))
    per = rows.groupBy("conv_id", "slice").agg(*[F.bit_xor(c).alias(f"all_{c}") for c in NAME], F.sum("size").alias("all_size"))
    earlier = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = per.select("conv_id", "slice", *[F.coalesce(F.bit_xor(f"all_{c}").over(earlier), F.lit(0)).alias(f"old_{c}") for c in NAME],
                         F.coalesce(F.sum("all_size").over(earlier), F.lit(0)).alias("old_size"))
    carried = carried.join(lengths, "conv_id")
    upto = Window.partitionBy("conv_id", "slice").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    near = rows.select("*", *[F.bit_xor(c).over(upto).alias(f"run_{c}") for c in NAME], F.sum("size").over(upto).alias("run_size"))
    own = [F.col(f"old_{c}").bitwiseXOR(F.col(f"run_{c}")) for c in NAME]
    deep = near.join(carried, ["conv_id", "slice"]).select(
        "conv_id", F.col("place").alias("depth"), *[x.alias(c) for x, c in zip(own, NAME)],
        *[x.bitwiseXOR(F.col(c)).alias(a) for x, c, a in zip(own, NAME, PARENT)],
        (F.col("old_size") + F.col("run_size") - F.col("size")).alias("bytes_before"), "size",
        (F.col("place") == F.col("n")).alias("ends"))
    zero = F.lit(0).cast("long")
    roots = lengths.select("conv_id", zero.alias("depth"), *[zero.alias(c) for c in NAME], *[zero.alias(c) for c in PARENT],
                           zero.alias("bytes_before"), zero.alias("size"), (F.col("n") == 0).alias("ends"))
    return stored(deep.unionByName(roots), "trie-paths")


def ended(path: DataFrame) -> DataFrame:
    """depth, p, q and ends_sha256 of nodes where conversations end."""
    key = ["depth", *NAME]
    ends = path.filter("ends").select(*key, "conv_id").repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id")
    names = [*key, "first", "piece", "digest"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Digests of nodes wholly within the partition; pieces of the first and the last node."""
        node, ids, first_node, out = None, [], None, []

        def close(edge: bool) -> None:
            if ids:
                text = ",".join(map(str, ids))
                out.append((*node, ids[0], text if edge else None, None if edge else hashlib.sha256(text.encode()).hexdigest()))

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 6
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        cut = False  # pieces of this node have been given away
        for batch in batches:
            for d, p, q, c in zip(*(column.to_pylist() for column in batch.columns)):
                if (d, p, q) != node:
                    if first_node is None:
                        first_node = (d, p, q)
                    close(cut or node == first_node)
                    node, ids, cut = (d, p, q), [], False
                elif len(ids) >= PIECE_IDS:
                    close(True)
                    ids, cut = [], True
                ids.append(c)
            if out:
                yield flush()
                out = []
        close(True)
        if out:
            yield flush()

    done = stored(ends.mapInArrow(pieces, "depth long, p long, q long, first long, piece string, digest string"), "trie-pieces")
    edges = done.filter("piece is not null").select(*key, "first", "piece").repartition(*key).sortWithinPartitions(*key, "first")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, out = None, None, []
        for batch in batches:
            for d, p, q, piece in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4))):
                if (d, p, q) != node:
                    if node:
                        out.append((*node, digest.hexdigest()))
                    node, digest = (d, p, q), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(piece.encode())
        if node:
            out.append((*node, digest.hexdigest()))
        columns = list(zip(*out)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 3 + [pa.string()])], names=[*key, "digest"])

    merged = edges.mapInArrow(digests, "depth long, p long, q long, digest string")
    return done.filter("piece is null").select(*key, "digest").unionByName(merged).withColumnRenamed("digest", "ends_sha256")


def peeled(runs: DataFrame) -> DataFrame:
    """Stored runs with n_children, n_leaves and saved (of the whole subtree, the run included).
    ``runs`` has top, bottom, the names of its deepest node and of the node above its top, n_convs,
    and bytes: those of the last texts of its nodes."""
    columns = runs.columns
    own = (F.col("n_convs") - 1) * F.col("bytes")
    single = runs.filter("n_convs = 1")
    # Runs of one member end with it: a leaf that saves nothing.
    leaf = [F.lit(0).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved")]
    finished = [stored(single.select(*columns, *leaf), "trie-runs")]
    fan = runs.filter("top > 0").groupBy((F.col("top") - 1).alias("bottom"), *[F.col(a).alias(c) for a, c in zip(PARENT, NAME)]).agg(
        F.count(F.lit(1)).alias("n_children"))
    key = ["bottom", *NAME]
    none = F.lit(0).cast("long")
    waiting = runs.filter("n_convs > 1").join(fan, key, "left").select(
        *columns, F.coalesce("n_children", none).alias("n_children"), none.alias("met"), none.alias("n_leaves"), none.alias("saved"))
    waiting, last = stored(waiting, "trie-waiting"), finished[0]
    while True:
        # The runs finished in the last round are stripped and grouped by what remains of them.
        stripped = last.filter("top > 0").groupBy((F.col("top") - 1).alias("bottom"), *[F.col(a).alias(c) for a, c in zip(PARENT, NAME)]).agg(
            F.count(F.lit(1)).alias("more_met"), F.sum("n_leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        now = waiting.join(stripped, key, "left").select(
            *columns, "n_children", *[(F.col(c) + F.coalesce(m, none)).alias(c) for c, m in (
                ("met", "more_met"), ("n_leaves", "more_leaves"), ("saved", "more_saved"))])
        now = stored(now, "trie-met")
        ready = now.filter("met = n_children").select(
            *columns, "n_children", F.greatest("n_leaves", F.lit(1).cast("long")).alias("n_leaves"), (F.col("saved") + own).alias("saved"))
        last, waiting = stored(ready, "trie-runs"), now.filter("met < n_children")
        if not last.limit(1).count():
            break
        finished.append(last)
    whole = finished[0]
    for more in finished[1:]:
        whole = whole.unionByName(more)
    return stored(whole, "trie-peeled")


def trie(path: DataFrame) -> DataFrame:
    """One row for each node of the conversations' paths."""
    key = ["depth", *NAME]
    nodes = path.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), *[F.min(c).alias(c) for c in PARENT],
        F.min("bytes_before").alias("bytes_before"), F.min("size").alias("size"),
        F.sum(F.col("ends").cast("long")).alias("n_ends"))
    nodes = stored(nodes, "trie-nodes")
    # Nodes with the same members are those of one conversation with the same count of members.
    line = ["conv_id", "n_convs"]
    runs = nodes.groupBy(*line).agg(
        F.min("depth").alias("top"), F.max("depth").alias("bottom"),
        F.min_by(F.struct(*PARENT), "depth").alias("above"), F.max_by(F.struct(*NAME), "depth").alias("at"), F.min("bytes_before").alias("from_bytes"), F.max(F.col("bytes_before") + F.col("size")).alias("to_bytes"))
    runs = stored(runs.select(*line, "top", "bottom", "at.*", "above.*", (F.col("to_bytes") - F.col("from_bytes")).alias("bytes"), "to_bytes"),
                  "trie-lines")
    done = peeled(runs)
    # Nodes of shared runs take from their run; those of single members need nothing.
    shared = done.filter("n_convs > 1").withColumn(
        "slice", F.explode(F.sequence(F.expr(f"top div {SLICE}"), F.expr(f"bottom div {SLICE}"))))
    shared = shared.select(*line, "slice", "bottom", "to_bytes", "n_children", "n_leaves", "saved", "bytes")
    many = nodes.filter("n_convs > 1").withColumn("slice", F.expr(f"depth div {SLICE}")).join(shared, [*line, "slice"]).select(
        *nodes.columns, F.when(F.col("depth") < F.col("bottom"), 1).otherwise(F.col("n_children")).cast("long").alias("n_children"), "n_leaves",
        # The run's own share is taken out and the share from this depth on put in.
        (F.col("saved") + (F.col("n_convs") - 1) * (F.col("to_bytes") - F.col("bytes_before") - F.col("bytes"))).alias("saved_tokens"))
    one = nodes.filter("n_convs = 1").select(
        *nodes.columns, (1 - F.col("n_ends")).alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"))
    full = many.unionByName(one).join(ended(path), key, "left")
    # Within a run the node above has the same smallest member; tops look theirs up.
    starts = done.filter("top > 0").select(*line, F.col("top").alias("depth"), *PARENT)
    above = done.select((F.col("bottom") + 1).alias("depth"), *[F.col(c).alias(a) for c, a in zip(NAME, PARENT)],
                        F.col("conv_id").alias("parent_conv_id"))
    tops = stored(starts.join(above, ["depth", *PARENT]).select(*line, "depth", "parent_conv_id"), "trie-tops")
    return full.join(tops, [*line, "depth"], "left").select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"))


def conversation_trie(turns: DataFrame) -> DataFrame:
    """The trie of the conversations as they are."""
    places = ranked(turns)
    return trie(paths(places, places.groupBy("conv_id").agg(F.max("place").alias("n"))))


def rebuilt_trie(turns: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    lengths, places = rebuilt(ranked(turns))
    return trie(paths(places, lengths))
