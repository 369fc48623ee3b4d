"""The prefix trie of conversations, with sums over subtrees from an Euler tour.

A turn is the digest of its role and text and its number of bytes; texts do not move. Every conversation is rebuilt
from the turns of two, and a prefix of its turns is a digest again, made over blocks so that long conversations need
no long windows. Equal prefixes are a node. Leaves and savings of a subtree are differences of prefix sums at the arcs
that enter and leave its top.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import cut, settle, ship
from ledgerloom.llm.ordering import numbered
from ledgerloom.llm.tour import subtree_sums

# Conversations of one base, and the most turns they take from it.
BASE, MOST_TAKEN = 5, 8
# Turns whose digests are put together at a time.
BLOCK = 64
# Bytes of joined ids that are kept as one piece.
PIECE_BYTES = 1 << 20


def taken_from_base(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % (MOST_TAKEN + 1)).cast("int")


def _digest(parts: Column) -> Column:
    return F.unhex(F.sha2(parts, 256))


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conversations (conv_id), and the turns (conv_id, at, turn_key, n_bytes) of the rebuilt ones, from 0."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    # The length in front keeps roles and texts apart.
    key = _digest(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    plain = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", key.alias("turn_key"), F.octet_length(text).cast("long").alias("n_bytes")
    )
    own = cut(numbered(plain, "conv_id", ["turn", "turn_key"], "at"))
    taken = taken_from_base(F.col("conv_id"))
    convs = cut(own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns")))
    # A base lends at most eight turns to at most five conversations.
    lent = own.filter(F.col("at") < MOST_TAKEN).select(F.col("conv_id").alias("base_id"), "at", "turn_key", "n_bytes")
    wanted = convs.select("conv_id", (F.col("conv_id") - F.col("conv_id") % BASE).alias("base_id"))
    first = wanted.join(lent, "base_id").filter(F.col("at") < taken).select("conv_id", "at", "turn_key", "n_bytes")
    had = first.groupBy("conv_id").agg(F.count(F.lit(1)).alias("had"))
    rest = own.filter(F.col("at") >= taken).join(had.withColumnRenamed("conv_id", "of_conv"), F.col("conv_id") == F.col("of_conv"), "left")
    rest = rest.select("conv_id", (F.col("at") - taken + F.coalesce("had", F.lit(0))).alias("at"), "turn_key", "n_bytes")
    return convs.select("conv_id"), cut(first.unionByName(rest))


def with_prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, at, turn_key, ...) with the digest of all turns up to and with each.

    A prefix is the digest of the full blocks before it, made in the same way from the blocks' own digests, and of the
    turns of its block up to it. A window sees one block, and a prefix depends on nothing but its turns.
    """
    block = F.floor(F.col("at") / BLOCK).cast("long")
    inside = Window.partitionBy("conv_id", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = F.array_join(F.transform(F.collect_list("turn_key").over(inside), lambda k: F.hex(k)), "")
    made = turns.withColumn("block", block).withColumn("prefix", _digest(parts.cast("binary")))
    longest = turns.agg(F.max("at")).first()[0]
    if longest is None or longest < BLOCK:
        return made.drop("block")
    made = cut(made)
    full = made.filter(F.col("at") % BLOCK == BLOCK - 1).select("conv_id", F.col("block").alias("at"), F.col("prefix").alias("turn_key"))
    above = with_prefixes(full).select(F.col("conv_id").alias("of_conv"), (F.col("at") + 1).alias("of_block"), F.col("prefix").alias("before"))
    joined = made.join(above, (F.col("conv_id") == F.col("of_conv")) & (F.col("block") == F.col("of_block")), "left")
    whole = _digest(F.concat(F.hex("before"), F.lit("/"), F.hex("prefix")).cast("binary"))
    return joined.withColumn("prefix", F.when(F.col("before").isNull(), F.col("prefix")).otherwise(whole)).drop(
        "block", "of_conv", "of_block", "before"
    )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of a node that follow each other, joined to pieces of bounded size."""
    node, first, ids, size = None, None, [], 0

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"node": [node], "first_id": [first], "ids": [",".join(ids)]}, schema=schema)

    schema = pa.schema([("node", pa.int64()), ("first_id", pa.int64()), ("ids", pa.string())])
    for batch in batches:
        for n, c in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (n != node or size > PIECE_BYTES):
                yield piece()
                ids, size = [], 0
            if not ids:
                node, first = n, c
            ids.append(str(c))
            size += len(ids[-1]) + 1
    if ids:
        yield piece()


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the pieces of each node as they come; only its state is kept."""
    node, state, nodes, found = None, None, [], []
    for batch in batches:
        for n, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if n != node:
                if state is not None:
                    nodes.append(node)
                    found.append(state.hexdigest())
                node, state = n, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if nodes:
            yield pa.RecordBatch.from_pydict({"of_node": pa.array(nodes, pa.int64()), "ends_sha256": found})
            nodes, found = [], []
    if state is not None:
        yield pa.RecordBatch.from_pydict({"of_node": pa.array([node], pa.int64()), "ends_sha256": [state.hexdigest()]})


def ends_hashes(ends: DataFrame) -> DataFrame:
    """of_node and ends_sha256, the hash of the ids (node, conv_id) that end at each node, ascending, joined by commas.

    Ids are sorted over ranges of node and id, so a node at which much of the table ends is sorted by many tasks, and
    reaches its hash, which has to be made from front to back, as a few pieces of about a megabyte.
    """
    sorted_ids = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = sorted_ids.mapInArrow(_pieces, "node long, first_id long, ids string")
    return pieces.repartition("node").sortWithinPartitions("node", "first_id").select("node", "ids").mapInArrow(
        _hashes, "of_node long, ends_sha256 string"
    )


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    ``turns`` has conv_id, turn, role and text. Turns of a conversation are ordered by turn, NULL first; those of one
    turn by a digest of role and text. NULL roles and texts are empty. Rows without conv_id belong to no conversation.
    A conversation c starts with the first h turns of conversation c - c % 5, where h is its crc32 modulo 9, and goes
    on with its own turns after its first h. A node stands for the conversations (members) that start with its turns;
    the root, of depth 0, for all, those without turns too. A repeated row is a turn of its own. Without conversations
    there are no nodes, and no root. Texts of any length are read whole; other columns are ignored.

    conv_id is the node's smallest member, which together with depth names it; parent_conv_id that of the node above,
    NULL for the root. n_convs counts members, n_children the nodes right below, n_leaves the nodes without children
    in the subtree, and saved_tokens sums over the subtree the bytes of each node's last text, times its members but
    one. ends_sha256 is the hash of the ids of the members that end at the node.
    """
    settle(turns.sparkSession)
    convs, rows = rebuilt_turns(turns)
    prefixes = cut(with_prefixes(rows).select("conv_id", (F.col("at") + 1).cast("long").alias("depth"), "prefix", "n_bytes"))
    # A conversation's last turn, or none.
    lasts = prefixes.groupBy("conv_id").agg(F.max("depth").alias("depth"))
    above = prefixes.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("above"))
    known = prefixes.join(above, ["conv_id", "depth"], "left")
    # The prefix settles the one above and the bytes.
    inner = known.groupBy("depth", "prefix", "n_bytes", "above").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    inner = inner.select("depth", "prefix", "conv_id", "n_convs", "n_bytes", F.hex("above").alias("above"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter(F.col("n_convs") > 0)
    nothing = F.lit(None)
    root = root.select(
        F.lit(0).cast("long").alias("depth"), nothing.cast("binary").alias("prefix"), "conv_id", "n_convs", F.lit(0).cast("long").alias("n_bytes"), nothing.cast("string").alias("above")
    )
    nodes = cut(inner.unionByName(root).withColumn("node", F.monotonically_increasing_id()))
    # Every node above is one of the nodes; the root has no prefix, so an empty one stands for it.
    tops = nodes.select(
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.coalesce(F.hex("prefix"), F.lit("")).alias("top"), (F.col("depth") + 1).alias("below")
    )
    mark = F.when(F.col("depth") > 0, F.coalesce("above", F.lit("")))
    placed = cut(nodes.join(tops, (F.col("depth") == F.col("below")) & (mark == F.col("top")), "left").drop("top", "below", "above"))
    counts = placed.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("of_parent")).agg(F.count(F.lit(1)).alias("n_children"))
    full = cut(
        placed.join(counts, F.col("node") == F.col("of_parent"), "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0)))
        .drop("of_parent")
    )
    tree = full.select(
        "node", "parent", F.col("conv_id").alias("place"), (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens")
    )
    sums = subtree_sums(tree, ["n_leaves", "saved_tokens"]).withColumnRenamed("node", "of_sum")
    numbers = full.select("node", "depth", F.coalesce(F.hex("prefix"), F.lit("")).alias("top"))
    last = convs.join(lasts, "conv_id", "left").select("conv_id", F.coalesce("depth", F.lit(0)).alias("depth"))
    last = last.join(prefixes, ["conv_id", "depth"], "left").select("conv_id", "depth", F.coalesce(F.hex("prefix"), F.lit("")).alias("top"))
    ends = ends_hashes(last.join(numbers, ["depth", "top"]).select("node", "conv_id"))
    return (
        full.join(sums, F.col("node") == F.col("of_sum"))
        .join(ends, F.col("node") == F.col("of_node"), "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )


ship("ledgerloom.llm.tour", __name__)
