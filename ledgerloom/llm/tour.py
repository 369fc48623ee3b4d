"""Euler tours of trees, ranked by contracting the list of their arcs.

Every node has an arc that enters it and one that leaves it. What follows an arc is known from the node's neighbours:
its first child, its next sibling, its parent. The list of arcs is ranked in rounds. In each, an arc whose hash is
below those of both its neighbours, about one in three, is taken out and hands what it holds to the arc behind it; so
the list shrinks by a third, and all rounds together cost about three lists. When few arcs are left they are ranked in
one task, and the rounds are undone: an arc taken out comes as far behind the arc before it as was noted.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, ship
from ledgerloom.llm.ordering import with_following

# Arcs that are ranked in one task.
CORE = 4096


def arcs(nodes: DataFrame, weights: list[str]) -> DataFrame:
    """The tour of ``nodes`` (node, parent, place, ...): arc, prev, next and the weights that its entering arcs hold.

    ``node`` is a number below 2^62, ``place`` orders siblings, the root's parent is NULL. Arc 2n enters node n and
    2n + 1 leaves it; leaving arcs hold nothing.
    """
    children = with_following(nodes.filter(F.col("parent").isNotNull()).select("node", "parent", "place"), "parent", "place", "node", "next_node", "is_first")
    firsts = children.filter("is_first").select(F.col("parent").alias("of_parent"), F.col("node").alias("first_child"))
    lead = children.select(F.col("node").alias("of_node"), "next_node")
    joined = nodes.join(lead, F.col("node") == F.col("of_node"), "left").join(firsts, F.col("node") == F.col("of_parent"), "left")
    enter, leave = 2 * F.col("node"), 2 * F.col("node") + 1
    # The arc behind each: (from, to, whether from enters).
    steps = F.array(
        F.struct(enter.alias("arc"), F.coalesce(2 * F.col("first_child"), leave).alias("next"), F.lit(1).alias("enters")),
        F.struct(leave.alias("arc"), F.coalesce(2 * F.col("next_node"), 2 * F.col("parent") + 1).alias("next"), F.lit(0).alias("enters")),
    )
    found = joined.select(F.explode(steps).alias("step"), *weights).select("step.arc", "step.next", *((F.col("step.enters") * F.col(w)).alias(w) for w in weights))
    before = found.filter(F.col("next").isNotNull()).select(F.col("next").alias("of_arc"), F.col("arc").alias("prev"), *(F.col(w).alias(f"{w}_") for w in weights))
    # What an arc holds goes to the distance of the arc behind it, from the arc before to itself.
    return found.join(before, F.col("arc") == F.col("of_arc"), "left").select(
        "arc", "prev", "next", F.when(F.col("prev").isNull(), 0).otherwise(1).cast("long").alias("rank"),
        *(F.coalesce(f"{w}_", F.lit(0)).cast("long").alias(w) for w in weights),
    )


def _goes(round_no: int) -> Column:
    """Whether an arc is taken out: never the first or last, and never two neighbours."""
    mark = lambda c: F.xxhash64(F.lit(round_no), F.col(c))
    inner = F.col("prev").isNotNull() & F.col("next").isNotNull()
    return F.coalesce(inner & (mark("arc") < mark("prev")) & (mark("arc") < mark("next")), F.lit(False))


def _walk(sums: list[str]):
    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = list(batches)
        if not rows:
            return
        table = pd.concat(rows).set_index("arc")
        distance = {arc: d for arc, *d in table[sums].itertuples()}
        behind = {prev: arc for arc, prev in table["prev"].items() if prev >= 0}
        heads = table.index[table["prev"] < 0]
        out = []
        for arc in heads:
            total = [0] * len(sums)
            while arc is not None:
                total = [t + d for t, d in zip(total, distance[arc])]
                out.append((arc, *total))
                arc = behind.get(arc)
        yield pd.DataFrame(out, columns=["arc", *sums])

    return walk


def ranked(linked: DataFrame, sums: list[str]) -> DataFrame:
    """arc and, for each of ``sums``, the total from the first arc to itself.

    ``linked`` (arc, prev, next, ...) holds for every arc what lies between the arc before it and itself. Arcs are
    whole numbers. Each round is stored, so lost executors cost no more than the round at hand.
    """
    state, rounds = cut(linked.select("arc", "prev", "next", *sums)), []
    while state.count() > CORE:
        goes = _goes(len(rounds))
        rounds.append((state, goes))
        nothing, zero = F.lit(None).cast("long"), [F.lit(0).cast("long").alias(s) for s in sums]
        stays = F.array(F.struct(F.col("arc").alias("to"), "prev", "next", *sums, F.lit(0).alias("says")))
        # The arc before gets a new next, the arc behind a new prev and a longer way to it.
        says = F.array(
            F.struct(F.col("prev").alias("to"), nothing.alias("prev"), F.col("next"), *zero, F.lit(1).alias("says")),
            F.struct(F.col("next").alias("to"), F.col("prev"), nothing.alias("next"), *sums, F.lit(1).alias("says")),
        )
        sent = state.select(F.explode(F.when(goes, says).otherwise(stays)).alias("m")).select("m.*")
        told = lambda c: F.coalesce(F.max(F.when(F.col("says") == 1, F.col(c))), F.max(F.when(F.col("says") == 0, F.col(c)))).alias(c)
        state = cut(
            sent.groupBy(F.col("to").alias("arc")).agg(told("prev"), told("next"), *(F.sum(s).alias(s) for s in sums))
        )
    fields = ", ".join(f"{c} long" for c in ["arc", *sums])
    # Pandas would make numbers with NULLs among them inexact.
    core = state.select("arc", F.coalesce("prev", F.lit(-1)).alias("prev"), *sums)
    found = cut(core.repartition(1).mapInPandas(_walk(sums), fields))
    for earlier, goes in reversed(rounds):
        gone = earlier.filter(goes).select(F.col("arc").alias("gone"), "prev", *(F.col(s).alias(f"{s}_") for s in sums))
        back = gone.join(found, F.col("prev") == F.col("arc")).select(F.col("gone").alias("arc"), *((F.col(s) + F.col(f"{s}_")).alias(s) for s in sums))
        found = cut(found.unionByName(back))
    return found


def subtree_sums(nodes: DataFrame, weights: list[str]) -> DataFrame:
    """node and, for each weight, its total over the node and all below it."""
    sums = ranked(arcs(nodes, weights), ["rank", *weights])
    at = lambda w, exit_: F.max(F.when(F.col("arc") % 2 == exit_, F.col(w)))
    return sums.groupBy(F.shiftright("arc", 1).alias("node")).agg(*((at(w, 1) - at(w, 0)).alias(w) for w in weights))


ship(__name__)
