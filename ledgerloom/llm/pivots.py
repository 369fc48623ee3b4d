"""Near-duplicate vectors through a pivot-permutation index.

A vector is described by its nearest reference points (pivots) in order. It is listed at the first few of them;
vectors that meet in a list and share enough of all their nearest pivots are candidates, whose cosine is then
computed in double precision. There are more pivots the more rows there are, so lists stay short. A list that
grows long all the same is divided by a second pivot: as candidates share two, they still meet. A pair that meets
in several lists belongs to the one with the lowest pivots, so every list can add up links and join groups by
itself, and no pair leaves its task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, settle, ship
from ledgerloom.llm.components import components

LEAST_COSINE = 0.93
# A pivot for about so many rows of the largest label, within these bounds and at most so many components in all.
ROWS_PER_PIVOT = 16
LEAST_PIVOTS, MOST_PIVOTS, MOST_COMPONENTS = 256, 1 << 14, 1 << 21
# Pivots are chosen from twice as many vectors, at least so many; every vector is indexed.
PIVOT_SAMPLE = 2048
# Nearest pivots that describe a vector, those it is listed at, and those a pair must share. Lists are divided by
# a second pivot, which loses no candidate as long as two must be shared.
DESCRIBED, LISTED, SHARED = 12, 6, 2
# Vectors of a list that are compared at a time; longer lists are compared in pairs of such blocks. From so many
# blocks on, each vector would be copied more often than by a list for each second pivot.
BLOCK = 2048
BLOCKS_UNDIVIDED = DESCRIBED - 1


def pivot_count(rows: int, size: int) -> int:
    """Pivots for vectors of ``size`` components, of which the largest label has ``rows``: a power of two."""
    wanted = 1 << max(0, (-(-rows // ROWS_PER_PIVOT) - 1).bit_length())
    room = 1 << ((MOST_COMPONENTS // size).bit_length() - 1 if size <= MOST_COMPONENTS else 0)
    return max(LEAST_PIVOTS, min(wanted, MOST_PIVOTS, room))


def _units(vectors) -> np.ndarray:
    """Vectors of one length divided by their norms; those of tiny or huge components are scaled first."""
    m = np.stack([np.asarray(v, np.float64) for v in vectors])
    largest = np.abs(m).max(axis=1, keepdims=True)
    m = np.where((largest < 1e-100) | (largest > 1e100), m / largest, m)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _spread_out(units: np.ndarray, most: int) -> np.ndarray:
    """The first of the vectors, then always the next that is no near copy of one taken; at most ``most``.

    A large group of near copies would otherwise own many pivots, all about equally near to each of its members.
    """
    taken = units[:0]
    for at in range(0, len(units), 512):
        block = units[at : at + 512]
        if len(taken):
            block = block[(block @ taken.T).max(axis=1) < LEAST_COSINE]
        alike, own = block @ block.T >= LEAST_COSINE, []
        for i in range(len(block)):
            if not alike[i, own].any():
                own.append(i)
        taken = np.concatenate([taken, block[own]])[:most]
        if len(taken) == most:
            break
    return taken


def _pivot_table(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Pivots for each dimension: spread-out unit vectors of a sample by hash, filled up with random directions."""
    per_label = vectors.groupBy(F.size("embedding").alias("size"), "label").agg(F.count(F.lit(1)).alias("n"))
    sizes = {r[0]: (r[1], pivot_count(r[2], r[0])) for r in per_label.groupBy("size").agg(F.sum("n"), F.max("n")).collect()}
    if not sizes:
        return {}
    buckets = 1 << 30
    keep, place = F.lit(False), F.xxhash64("embedding")
    for d, (n, pivots) in sorted(sizes.items()):
        bound = min(buckets, -(-buckets * max(PIVOT_SAMPLE, 2 * pivots) // n))
        keep = keep | ((F.size("embedding") == d) & (F.pmod(place, F.lit(buckets)) < bound))
    picked = vectors.filter(keep).select(place.alias("place"), "embedding").toArrow()
    # Equal vectors of two labels are near copies too: the order among them changes nothing.
    order = np.argsort(picked["place"].to_numpy(), kind="stable")
    found = picked["embedding"].to_numpy()[order]
    table = {}
    for d, (_, pivots) in sizes.items():
        own = [v for v in found if len(v) == d]
        units = _spread_out(_units(own), pivots) if own else np.zeros((0, d))
        drawn = np.random.default_rng(d).standard_normal((pivots - len(units), d))
        table[d] = np.concatenate([units, drawn / np.linalg.norm(drawn, axis=1, keepdims=True)])
    return table


def described(vectors: DataFrame, table: dict[int, np.ndarray]) -> DataFrame:
    """``vectors`` (rep_id, embedding, ...) with the numbers of their nearest pivots, nearest first."""
    sent = vectors.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("array<int>")
    def nearest(rows: pd.Series) -> pd.Series:
        out, values, lengths = [None] * len(rows), rows.to_numpy(), rows.map(len).to_numpy()
        for d in np.unique(lengths):
            places = np.flatnonzero(lengths == d)
            for at in range(0, len(places), 256):
                part = places[at : at + 256]
                far = -(_units(values[part]) @ sent.value[int(d)].T)
                few = np.argpartition(far, DESCRIBED, axis=1)[:, :DESCRIBED]
                few = np.take_along_axis(few, np.argsort(np.take_along_axis(far, few, 1), axis=1, kind="stable"), 1)
                for i, found in zip(part, few.astype(np.int32)):
                    out[i] = found
        return pd.Series(out, index=rows.index, dtype=object)

    return vectors.withColumn("nearest", nearest("embedding"))


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable number of each of 0..n-1 over the links a-b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while (new != (hop := new[new])).any():
            new = hop
        if (new == root).all():
            break
        root = new
    return root


def _candidates(near: np.ndarray, first: np.ndarray, second: np.ndarray):
    """For each row of ``first``, itself and the rows of ``second`` behind it that share enough pivots with it.

    Shared pivots are counted along inverted lists: where each pivot of the row occurs among ``second``.
    """
    codes = np.unique(near, return_inverse=True)[1].reshape(near.shape)
    order = np.argsort(codes[second].ravel(), kind="stable")
    holders = order // near.shape[1]
    ends = np.cumsum(np.bincount(codes[second].ravel(), minlength=codes.max() + 1))
    starts = np.concatenate([[0], ends[:-1]])
    for i in first:
        met = np.concatenate([holders[starts[c] : ends[c]] for c in codes[i]])
        yield i, second[np.bincount(met, minlength=len(second)) >= SHARED]


def _owned(near: np.ndarray, i: int, others: np.ndarray, pivot: int, second_pivot: int) -> np.ndarray:
    """Those of ``others`` whose pair with row ``i`` belongs to this list: no lower list has both."""
    lower = near[i, :LISTED][near[i, :LISTED] < pivot]
    if len(lower):
        others = others[~(near[others, :LISTED, None] == lower).any(axis=(1, 2))]
    if second_pivot >= 0:
        lower = near[i][(near[i] < second_pivot) & (near[i] != pivot)]
        if len(lower):
            others = others[~(near[others][:, :, None] == lower).any(axis=(1, 2))]
    return others


def _compare(rows: pd.DataFrame) -> pd.DataFrame:
    """Links of one list, or of two of its blocks: for each vector linked, its links and the group's first vector."""
    pivot, second_pivot, left, right = (int(rows[c].iloc[0]) for c in ("pivot", "second", "left", "right"))
    rows = rows.sort_values("rep_id", kind="stable").reset_index(drop=True)
    units, near = _units(rows["embedding"]), np.stack([np.asarray(v) for v in rows["nearest"]])
    block = rows["block"].to_numpy()
    first, second = np.flatnonzero(block == left), np.flatnonzero(block == right)
    found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i, others in _candidates(near, first, second):
        if left == right:
            others = others[others > i]
        others = _owned(near, i, others, pivot, second_pivot)
        linked = others[units[others] @ units[i] >= LEAST_COSINE]
        if len(linked):
            found_a.append(np.full(len(linked), i))
            found_b.append(linked)
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    copies, ids = rows["copies"].to_numpy(np.int64), rows["rep_id"].to_numpy(np.int64)
    links = np.bincount(a, copies[b], len(rows)) + np.bincount(b, copies[a], len(rows))
    some = np.flatnonzero(links)
    return pd.DataFrame({"rep_id": ids[some], "links": links[some].astype(np.int64), "first_id": ids[_roots(len(rows), a, b)][some]})


def _with_blocks(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` of lists that hold more than one, with the number of blocks of their list."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    sizes = sizes.select(*(F.col(k).alias(f"of_{k}") for k in keys), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"of_{k}"))
    return rows.join(sizes, same).drop(*(f"of_{k}" for k in keys))


def lists(rows: DataFrame) -> DataFrame:
    """Described rows in every list, dealt to the pairs of blocks that are compared."""
    listed = rows.select("rep_id", "label", "copies", "embedding", "nearest", F.explode(F.slice("nearest", 1, LISTED)).alias("pivot"))
    met = _with_blocks(listed.withColumn("size", F.size("embedding")), ["label", "size", "pivot"])
    whole = met.filter(F.col("blocks") <= BLOCKS_UNDIVIDED).withColumn("second", F.lit(-1))
    divided = met.filter(F.col("blocks") > BLOCKS_UNDIVIDED).drop("blocks")
    divided = divided.withColumn("second", F.explode(F.array_remove("nearest", F.col("pivot"))))
    dealt = whole.unionByName(_with_blocks(divided, ["label", "size", "pivot", "second"]))
    own = F.pmod(F.xxhash64("rep_id"), F.col("blocks")).cast("int")
    return (
        dealt.withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "label", "size", "pivot", "second", "rep_id", "copies", "embedding", "nearest", "block",
            F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"),
        )
    )


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row; only vectors of one label that is not NULL link.

    Vectors that are NULL, empty, all zero, or hold NULL or non-finite components link with nothing, and neither do
    those without vec_id, whose component_id is NULL and kept false. Vectors of different lengths never link. Equal
    vectors are compared once, as one vector that counts as often as it occurs; a repeated row is another vector.
    Other columns are ignored.
    """
    settle(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    sound = F.coalesce(
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & (F.size("embedding") > 0)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists("embedding", lambda x: x != 0),
        F.lit(False),
    )
    # Minus zero is zero: equal vectors are then equal as values.
    marked = rows.withColumn("sound", sound).withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0)))
    distinct = cut(
        marked.filter("sound").groupBy("label", "embedding").agg(F.min("vec_id").alias("rep_id"), F.count(F.lit(1)).alias("copies"))
    )
    table = _pivot_table(distinct)
    found = (
        lists(cut(described(distinct, table)))
        .groupBy("label", "size", "pivot", "second", "left", "right")
        .applyInPandas(_compare, "rep_id long, links long, first_id long")
        if table
        else distinct.select("rep_id", F.lit(0).cast("long").alias("links"), F.col("rep_id").alias("first_id")).limit(0)
    )
    found = cut(found)
    links = found.groupBy("rep_id").agg(F.sum("links").alias("links"))
    roots = components(found, "rep_id", "first_id")
    named = (
        distinct.join(links, "rep_id", "left")
        .join(roots, F.col("rep_id") == F.col("node"), "left")
        .select(
            F.col("label").alias("of_label"),
            F.col("embedding").alias("of_embedding"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("root", "rep_id").alias("root"),
        )
    )
    joined = marked.join(
        named, F.col("sound") & (F.col("label") == F.col("of_label")) & (F.col("embedding") == F.col("of_embedding")), "left"
    )
    component = F.coalesce("root", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


ship(__name__)
