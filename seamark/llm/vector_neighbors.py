"""The most similar vectors of every vector (problem 1).

NN-descent: a graph of the k nearest neighbours is improved by joins of neighbours with their
neighbours. Each round ships every vector to the lists it stands in (a join), groups the lists by
their owner (a shuffle), compares the members of a list with each other in numpy, and keeps the
proposals that beat a member's worst neighbour. Only members that are new in a list are compared with
the others, and rounds go on until the graph has settled. The first graph comes from leaves of random
rotations: vectors whose largest coordinates after a rotation agree. Queries walk the finished
graph greedily: every round expands the best nodes seen so far.

Vectors compare only within one model. Identical vectors form one class, which is opened at the
end, so copies neither crowd a leaf nor fill the lists. A crowded leaf is split at random, a long
list of those who name a vector is split into blocks; every vector stays in.

Defined results: a vector that is null, all zero, holds a null or NaN or infinity, or has another length than
its ``dim`` takes no part, nor does a row with null id or model; a repeated id counts once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seamark.functions.dist import cut, discard, lookup_join, map_groups

K = 16
TABLES = 10
LEAF = 96
BLOCK = 32


def unit_vectors(df: DataFrame, id_col: str = "chunk_id") -> DataFrame:
    """``id, model, vec``: usable vectors scaled to length 1, as bytes of float32."""

    def run(batches):
        for b in batches:
            emb = b.column("embedding")
            out = []
            for e, d in zip(emb, b.column("dim").to_pylist(), strict=True):
                v = np.asarray(e.values.to_numpy(zero_copy_only=False), np.float64) if e.is_valid else np.zeros(0)
                ok = d is not None and len(v) == d and d > 0 and np.isfinite(v).all() and np.abs(v).max() > 0
                if ok:
                    v = v / np.abs(v).max()
                    out.append((v / np.linalg.norm(v)).astype(np.float32).tobytes())
                else:
                    out.append(None)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("model"), pa.array(out, pa.binary())], names=["id", "model", "vec"])

    rows = df.select(F.col(id_col).alias("id"), "model", "dim", "embedding").where("id IS NOT NULL AND model IS NOT NULL AND embedding IS NOT NULL")
    return rows.dropDuplicates(["id"]).mapInArrow(run, "id string, model string, vec binary").where("vec IS NOT NULL")


def _matrix(col: pa.ChunkedArray | pa.Array, dtype) -> np.ndarray:
    rows = col.to_pylist()
    return np.frombuffer(b"".join(rows), dtype).reshape(len(rows), -1).astype(np.float32)


def _leaf_codes(x: np.ndarray, table: int, depth: int) -> np.ndarray:
    """Per vector the signed axis of its largest coordinate under ``depth`` random rotations."""
    d = x.shape[1]
    out = np.zeros(len(x), np.int64)
    for k in range(depth):
        r = np.random.default_rng([d, table, k]).standard_normal((d, d)).astype(np.float32)
        y = x @ r
        at = np.abs(y).argmax(1)
        out = out * (2 * d + 1) + 2 * at + (y[np.arange(len(x)), at] > 0)
    return out


def leaves(nodes: DataFrame, n_nodes: int, tables: int) -> DataFrame:
    """``model, tbl, leaf, v, vec``: every node once in each table."""
    depth = 1
    while depth < 4 and n_nodes / 100.0**depth > LEAF:
        depth += 1

    def run(batches):
        for b in batches:
            models = np.array(b.column("model").to_pylist(), object)
            v, vec = b.column("v"), b.column("vec")
            for m in dict.fromkeys(models):
                i = np.flatnonzero(models == m)
                x = _matrix(vec.take(pa.array(i)), np.float32)
                half = pa.array([r.tobytes() for r in x.astype(np.float16)], pa.binary())
                for t in range(tables):
                    n = len(i)
                    yield pa.RecordBatch.from_arrays([pa.array([m] * n, pa.string()), pa.array(np.full(n, t), pa.int32()), pa.array(_leaf_codes(x, t, depth)), v.take(pa.array(i)), half], names=["model", "tbl", "leaf", "v", "vec"])

    return nodes.mapInArrow(run, "model string, tbl int, leaf bigint, v bigint, vec binary")


def _top(edges: DataFrame, k: int) -> DataFrame:
    """The k most similar distinct ``w`` of each ``v``: ``v, list`` of ``struct<s, w>``, best first.

    Ranks are limited before and after the shuffle, so the proposals of a hub are never held together."""
    best = edges.groupBy("v", "w").agg(F.max("s").alias("s"))
    place = F.row_number().over(Window.partitionBy("v").orderBy(F.desc("s"), F.desc("w")))
    best = best.withColumn("r", place).where(F.col("r") <= k)
    return best.groupBy("v").agg(F.sort_array(F.collect_list(F.struct("s", "w")), asc=False).alias("list"))


def first_graph(nodes: DataFrame, n_nodes: int, k: int, tables: int) -> DataFrame:
    rows = leaves(nodes, n_nodes, tables)
    sizes = rows.groupBy("model", "tbl", "leaf").agg(F.count(F.lit(1)).alias("n"))
    crowded = sizes.where(F.col("n") > 4 * LEAF).select("model", "tbl", "leaf", F.ceil(F.col("n") / (2 * LEAF)).alias("parts"))
    rows = rows.join(crowded, ["model", "tbl", "leaf"], "left").withColumn("part", F.pmod(F.xxhash64("v", "tbl"), F.coalesce("parts", F.lit(1))))

    def near(t: pa.Table):
        n = t.num_rows
        if n < 2:
            return None
        x, v = _matrix(t.column("vec"), np.float16), t.column("v").to_numpy()
        s = x @ x.T
        np.fill_diagonal(s, -2)
        c = min(k, n - 1)
        at = np.argpartition(-s, c - 1, axis=1)[:, :c]
        i = np.repeat(np.arange(n), c)
        return {"v": v[i], "w": v[at.ravel()], "s": s[i, at.ravel()]}

    return _top(map_groups(rows.drop("parts"), ["model", "tbl", "leaf", "part"], near, "v bigint, w bigint, s float"), k)


def descend(nodes: DataFrame, graph: DataFrame, k: int) -> DataFrame:
    """One round: proposals ``v, w, s`` from comparing neighbours of neighbours.

    ``graph`` has ``v, list`` and ``fresh``, the entries that came in the last round. Two members of a list meet
    if one of them is fresh there, the others have met before; lists without a fresh member are left out."""
    half = nodes.select("v", "vec")
    edges = graph.select("v", "fresh", F.explode("list").alias("e")).select("v", F.col("e.w").alias("w"), F.array_contains("fresh", F.col("e.w")).alias("new"))
    own = edges.select(F.col("v").alias("owner"), F.col("w").alias("v"), "new")
    rev = edges.select(F.col("w").alias("owner"), "v", "new")
    # Those who name the owner come in blocks of a bounded size; each block meets the owner's own list.
    named = rev.groupBy("owner").agg(F.count(F.lit(1)).alias("n"), F.max("new").alias("moved"))
    owners = graph.select(F.col("v").alias("owner"), (F.size("fresh") > 0).alias("mine")).join(named, "owner", "left")
    owners = cut(owners.where("mine OR moved").select("owner", F.ceil(F.coalesce("n", F.lit(1)) / BLOCK).cast("int").alias("blocks")))
    rev = lookup_join(rev, owners, "owner").withColumn("block", F.pmod(F.xxhash64("v", "owner"), F.col("blocks")).cast("int")).drop("blocks")
    own = own.join(owners, "owner").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    worst = graph.select("v", F.when(F.size("list") < k, F.lit(-2.0)).otherwise(F.element_at("list", -1)["s"]).cast("float").alias("worst"))
    info = half.join(worst, "v", "left").select("v", "vec", F.coalesce("worst", F.lit(-2.0).cast("float")).alias("worst"))
    # A hub stands in the lists of very many: its vector is broadcast to them (fewer than 2,048 such).
    lists = lookup_join(cut(own.unionByName(rev)), info, "v")

    def meet(t: pa.Table):
        v, first, which = np.unique(t.column("v").to_numpy(), return_index=True, return_inverse=True)
        if len(v) < 2:
            return None
        new = np.zeros(len(v), bool)
        np.logical_or.at(new, which, t.column("new").to_numpy(zero_copy_only=False))
        t = t.take(pa.array(first))
        x, worst = _matrix(t.column("vec"), np.float16), t.column("worst").to_numpy()
        s = x @ x.T
        np.fill_diagonal(s, -3)
        i, j = np.nonzero((s > worst[:, None]) & (new[:, None] | new[None, :]))
        return {"v": v[i], "w": v[j], "s": s[i, j]}

    return map_groups(lists, ["owner", "block"], meet, "v bigint, w bigint, s float")


def build_graph(nodes: DataFrame, k: int = K, tables: int = TABLES, max_rounds: int = 60, settled: float = 0.01) -> DataFrame:
    """``v, list`` of ``struct<s, w>``: NN-descent until fewer than ``settled`` of all entries change;
    raises where that takes more than ``max_rounds``, instead of giving an unsettled graph."""
    n_nodes = nodes.count()
    half = nodes.select("v", "model", "vec")
    names = lambda c: F.transform(c, lambda e: e["w"])
    graph = cut(first_graph(half, n_nodes, k, tables).withColumn("fresh", names("list")))

    def halve(batches):
        for b in batches:
            rows = [np.frombuffer(x, np.float32).astype(np.float16).tobytes() for x in b.column("vec").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("v"), pa.array(rows, pa.binary())], names=["v", "vec"])

    small = nodes.select("v", "vec").mapInArrow(halve, "v bigint, vec binary")
    for _ in range(max_rounds):
        new = descend(small, graph, k)
        old = graph.select("v", F.explode("list").alias("e")).select("v", F.col("e.w").alias("w"), F.col("e.s").alias("s"))
        before = graph.select("v", names("list").alias("before"))
        merged = _top(old.unionByName(new), k).join(before, "v", "left")
        fresh = F.array_except(names("list"), F.coalesce("before", F.expr("cast(array() as array<bigint>)")))
        merged = cut(merged.select("v", "list", fresh.alias("fresh")))
        changed = merged.agg(F.sum(F.size("fresh"))).first()[0] or 0
        discard(graph)
        graph = merged
        if changed <= settled * k * max(n_nodes, 1):
            return graph.select("v", "list")
    raise RuntimeError(f"the graph has not settled after {max_rounds} rounds")


def classes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``v, model, vec`` for each distinct vector of a model, and ``id, v`` for each row."""
    nodes = cut(vectors.groupBy("model", "vec").agg(F.count(F.lit(1)).alias("copies")).withColumn("v", F.monotonically_increasing_id()), spread=True)
    members = vectors.join(nodes.select("model", "vec", "v"), ["model", "vec"]).select("id", "v")
    return nodes.select("v", "model", "vec"), cut(members)


def exact_similarity(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``v, w, s`` with the cosine in double precision."""
    a, b = nodes.select("v", F.col("vec").alias("va")), nodes.select(F.col("v").alias("w"), F.col("vec").alias("vb"))

    def run(batches):
        for t in batches:
            if t.num_rows:
                s = np.array([np.dot(np.frombuffer(x, np.float32).astype(np.float64), np.frombuffer(y, np.float32)) / np.sqrt(np.sum(np.frombuffer(x, np.float32).astype(np.float64) ** 2) * np.sum(np.frombuffer(y, np.float32).astype(np.float64) ** 2)) for x, y in zip(t.column("va").to_pylist(), t.column("vb").to_pylist(), strict=True)])
                yield pa.RecordBatch.from_arrays([t.column("v"), t.column("w"), pa.array(s)], names=["v", "w", "s"])

    return lookup_join(cut(edges.select("v", "w")), b, "w").join(a, "v").select("v", "w", "va", "vb").mapInArrow(run, "v bigint, w bigint, s double")


def similar_pairs(df: DataFrame, top: int = 5, least: float = 0.8) -> DataFrame:
    """``a, b``: pairs of cosine ``least`` or more where either is among the other's ``top``."""
    nodes, members = classes_of(unit_vectors(df))
    graph = build_graph(nodes)
    edges = graph.select("v", F.explode("list").alias("e")).where(F.col("e.s") >= least - 0.01).select("v", F.col("e.w").alias("w"))
    near = exact_similarity(edges, nodes).where(F.col("s") >= least)
    # The first members of a class, smallest ids first: no more can be among anyone's top.
    rank = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    some = cut(members.select("v", "id").groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("one")))
    many = some.where("n > 1").select("v")
    heads = members.join(many, "v", "left_semi").withColumn("r", rank).where(F.col("r") <= top + 1).select("v", "id")
    heads = cut(heads.unionByName(some.where("n = 1").select("v", F.col("one").alias("id"))).withColumnRenamed("id", "other"))
    same = heads.join(many, "v", "left_semi").select("v", "other", F.lit(1.0).alias("s"))
    few = heads.groupBy(F.col("v").alias("w")).agg(F.collect_list("other").alias("others"))  # at most top + 1 a class
    across = lookup_join(cut(near), few, "w").select("v", F.explode("others").alias("other"), "s")
    best = F.row_number().over(Window.partitionBy("v").orderBy(F.desc(F.round("s", 12)), "other"))
    # Of each class the best top + 1 others; a member that finds itself among them takes the next.
    lists = same.unionByName(across).withColumn("r", best).where(F.col("r") <= top + 1)
    lists = lists.groupBy("v").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "other"))), lambda x: x["other"]).alias("others"))
    each = lookup_join(members, lists, "v").select("id", F.explode(F.slice(F.array_remove("others", F.col("id")), 1, top)).alias("other"))
    return each.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()


def search(df: DataFrame, queries: DataFrame, top: int = 5, beam: int = 24, max_rounds: int = 200) -> DataFrame:
    """``query, id, s``: the ``top`` most similar rows of every query (``id, model, vec``), found by
    greedy walks on the graph; a query's own id is left out, its copies are not. A walk ends when all
    of the ``beam`` best nodes it has seen are expanded; more than ``max_rounds`` raise."""
    nodes, members = classes_of(unit_vectors(df))
    graph = cut(build_graph(nodes))
    n = nodes.count()
    start = leaves(nodes, n, 2).select("model", "tbl", "leaf", F.col("v").alias("w"))
    first = F.row_number().over(Window.partitionBy("model", "tbl", "leaf").orderBy(F.xxhash64("w")))
    start = start.withColumn("r", first).where(F.col("r") <= beam).drop("r")  # entry points only
    q = cut(queries.select(F.monotonically_increasing_id().alias("q"), "id", "model", "vec"))
    ql = leaves(q.select(F.col("q").alias("v"), "model", "vec"), n, 2).select(F.col("v").alias("q"), "model", "tbl", "leaf")
    anywhere = nodes.withColumn("r", F.row_number().over(Window.partitionBy("model").orderBy(F.xxhash64("v")))).where(F.col("r") <= 8).select("model", F.col("v").alias("w"))
    cand = ql.join(start, ["model", "tbl", "leaf"]).select("q", "w").unionByName(q.join(F.broadcast(anywhere), "model").select("q", "w")).distinct()
    qv, nv = q.select("q", F.col("vec").alias("va")), nodes.select(F.col("v").alias("w"), F.col("vec").alias("vb"))

    def score(c: DataFrame) -> DataFrame:
        pairs = lookup_join(cut(c), nv, "w").join(qv, "q").select(F.col("q").alias("v"), "w", "va", "vb")

        def run(batches):
            for t in batches:
                if t.num_rows:
                    s = (_matrix(t.column("va"), np.float32) * _matrix(t.column("vb"), np.float32)).sum(1) if len({len(x) for x in t.column("va").to_pylist()}) == 1 else np.array([np.dot(np.frombuffer(x, np.float32), np.frombuffer(y, np.float32)) for x, y in zip(t.column("va").to_pylist(), t.column("vb").to_pylist(), strict=True)])
                    yield pa.RecordBatch.from_arrays([t.column("v"), t.column("w"), pa.array(s.astype(np.float64))], names=["q", "w", "s"])

        return pairs.mapInArrow(run, "q bigint, w bigint, s double")

    ahead = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s"), "w"))
    seen = cut(score(cand).withColumn("done", F.lit(False)))
    for _ in range(max_rounds):
        ranked = seen.withColumn("r", ahead).where(F.col("r") <= 4 * beam)
        open_ = ranked.where((F.col("r") <= beam) & ~F.col("done")).select("q", F.col("w").alias("v"))
        nxt = open_.join(graph, "v").select("q", F.explode("list").alias("e")).select("q", F.col("e.w").alias("w")).distinct().join(seen.select("q", "w"), ["q", "w"], "left_anti")
        new = cut(score(nxt).withColumn("done", F.lit(False)))
        if new.isEmpty():
            break
        old, seen = seen, cut(ranked.select("q", "w", "s", (F.col("done") | (F.col("r") <= beam)).alias("done")).unionByName(new))
        discard(old)
        discard(new)
    else:
        raise RuntimeError(f"walks are not over after {max_rounds} rounds")
    found = seen.withColumn("r", ahead).where(F.col("r") <= top + 1).select("q", "w", "s")
    rank = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    heads = members.withColumn("r", rank).where(F.col("r") <= top + 1).select(F.col("v").alias("w"), F.col("id").alias("other"))
    rows = found.join(heads, "w").join(q.select("q", "id"), "q").where("other <> id")
    rows = rows.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc(F.round("s", 6)), "other"))).where(F.col("r") <= top)
    return rows.select(F.col("id").alias("query"), F.col("other").alias("id"), F.col("s"))
