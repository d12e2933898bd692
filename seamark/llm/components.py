"""Groups of records that are linked directly or indirectly (problem 5).

Random contraction: in each round every vertex hooks to the neighbour (or itself) that comes
first in a fresh hash order, all edges are relabelled by these hooks and deduplicated, and the
rounds go on until no edge is left; each shrinks the vertices by a constant factor in expectation,
whatever the shape of the graph. The hooks of all rounds are then expanded back to the vertices,
from the last and smallest round to the first. A vertex of huge degree or a label of most vertices
costs no more than others: minima are pre-aggregated before the shuffle, and relabelling and
expansion are lookup joins that broadcast hot keys.

Defined results: null ids make no link and no record, an id beside a null still is a record; self
pairs and repeated pairs add nothing; empty tables give no rows; the group's name is its smallest id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamark.functions.dist import cut, discard, lookup_join


HOT_SHARE = 1024


def _hooks(edges: DataFrame, turn: int) -> DataFrame:
    """``v, to, degree``: each vertex and the first of its closed neighbourhood in this turn's order."""
    both = edges.select(F.col("a").alias("v"), F.col("b").alias("w")).unionByName(edges.select(F.col("b").alias("v"), F.col("a").alias("w")))
    order = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(turn)).alias("h"), F.col(c).alias("id"))
    near = both.groupBy("v").agg(F.min(order("w")).alias("m"), F.count(F.lit(1)).alias("degree"))
    return near.select("v", F.least(order("v"), F.col("m"))["id"].alias("to"), "degree")


def _swap(edges: DataFrame, end: str, hooks: DataFrame, n_edges: int) -> DataFrame:
    """Replace column ``end`` by its hook. Vertices with more than 1/1024 of all edge ends, fewer than
    1024 of them in any graph, are broadcast; no other vertex can make a partition of the join hot."""
    to = hooks.select(F.col("v").alias(end), F.col("to").alias("__to"), (F.col("degree") * HOT_SHARE > 2 * n_edges).alias("__hot"))
    hot = F.broadcast(to.where("__hot").drop("__hot"))
    part = edges.join(hot, end, "left")
    easy = part.where("__to IS NOT NULL")
    rest = part.where("__to IS NULL").drop("__to").join(to.where("NOT __hot").drop("__hot"), end)
    return easy.unionByName(rest).drop(end).withColumnRenamed("__to", end)


def _relabel(edges: DataFrame, hooks: DataFrame, n_edges: int) -> DataFrame:
    step = _swap(_swap(edges, "a", hooks, n_edges), "b", hooks, n_edges)
    return step.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(vertices: DataFrame, edges: DataFrame, max_turns: int = 200) -> DataFrame:
    """``id, group_id`` for every ``id`` of ``vertices`` and both ends of ``edges`` (``a, b``)."""
    edges = edges.select("a", "b").where("a <> b")  # drops nulls as well
    edges = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    first, turns = edges, []
    for turn in range(max_turns):
        n_edges = edges.count()
        if not n_edges:
            break
        hooks = cut(_hooks(edges, turn))
        turns.append(hooks)
        edges, old = cut(_relabel(edges, hooks, n_edges)), edges
        if old is not first:
            discard(old)
    else:
        raise RuntimeError(f"edges are left after {max_turns} turns")
    ids = vertices.select("id").where("id IS NOT NULL")
    if not turns:
        return ids.distinct().select("id", F.col("id").alias("group_id"))
    # From the last turn back: the vertices of a turn take the final label of what they hooked to. A label
    # that is no vertex of the next turn is final, all its edges had gone. The tables shrink from turn to
    # turn, so all of them together are of the size of the first.
    root = turns[-1].select("v", "to")
    for hooks in reversed(turns[:-1]):
        final = root.select(F.col("v").alias("to"), F.col("to").alias("__final"))
        root = cut(lookup_join(hooks.select("v", "to"), final, "to", HOT_SHARE, "left").select("v", F.coalesce("__final", "to").alias("to")))
    name = root.groupBy("to").agg(F.min("v").alias("group_id"))
    named = lookup_join(root, name, "to", HOT_SHARE).select(F.col("v").alias("id"), "group_id")
    every = reduce(DataFrame.unionByName, [ids, first.select(F.col("a").alias("id")), first.select(F.col("b").alias("id"))]).distinct()
    return every.join(named, "id", "left").select("id", F.coalesce("group_id", "id").alias("group_id"))


def mention_groups(mentions: DataFrame, matches: DataFrame, linked: DataFrame) -> DataFrame:
    """``mention_id, group_id`` over mentions, their pairwise matches and their linked lists."""
    lists = linked.select(F.array_compact("mention_ids").alias("m")).where("size(m) > 0")
    star = lists.select(F.element_at("m", 1).alias("a"), F.explode("m").alias("b"))
    pairs = matches.select(F.col("mention_a").alias("a"), F.col("mention_b").alias("b"))
    both = pairs.unionByName(star)
    ids = mentions.select(F.col("mention_id").alias("id")).unionByName(both.select(F.explode(F.array("a", "b")).alias("id")))
    return components(ids, both).select(F.col("id").alias("mention_id"), "group_id")
