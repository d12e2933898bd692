"""Helpers for plans that must survive lost executors and hot keys."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _folder(spark: SparkSession) -> str:
    """The application's own folder for tables, below ``spark.checkpoint.dir``."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="seamark-ckpt-"))  # one process: its own folder will do
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame, spread: bool = False) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: its lineage ends there.

    On more than one process ``spark.checkpoint.dir`` must be set, else this raises. A table is written
    rather than a checkpoint, because checkpoints carry the constraints of their plans along, which
    pile up over the rounds of an iteration. ``spread`` deals the rows out evenly first, for steps
    whose cost is computing, not bytes. ``discard`` deletes a table that no later plan reads;
    ``release`` deletes all of an application once its results are taken.
    """
    spark = df.sparkSession
    path = f"{_folder(spark)}/table-{uuid.uuid4().hex}"
    (df.repartition(n_partitions(df)) if spread else df).write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._table_path = path
    return back


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def discard(table_df: DataFrame) -> None:
    """Delete the table behind a result of ``cut``; no plan may read it from then on."""
    if path := getattr(table_df, "_table_path", None):
        _delete(table_df.sparkSession, path)


def release(spark: SparkSession) -> None:
    """Delete all tables of the application, when results of earlier plans are no longer read."""
    if spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        _delete(spark, spark.sparkContext._jsc.sc().getCheckpointDir().get())


def n_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def map_groups(df: DataFrame, keys: list[str], fn: Callable[[pa.Table], Iterator[dict] | dict | None], schema: str, shuffled: bool = False) -> DataFrame:
    """Run ``fn`` once for each distinct ``keys`` on that group's rows as an Arrow table.

    ``fn`` returns a dict of columns (or None). Callers bound the size of a group. Many small
    groups share one Arrow batch, so the cost of a group is a slice, not a round trip.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    sc_schema = df.sparkSession.createDataFrame([], schema).schema
    names = [f.name for f in sc_schema.fields]
    out_schema = to_arrow_schema(sc_schema)

    def run(batches):
        pend: list[pa.RecordBatch] = []
        held: list[dict] = []
        n_held = 0

        def flush():
            nonlocal held, n_held
            cols = []
            for i, c in enumerate(names):
                parts = [pa.array(h[c], type=out_schema.field(i).type) for h in held]
                cols.append(pa.concat_arrays(parts))
            held, n_held = [], 0
            return pa.RecordBatch.from_arrays(cols, names=names)

        def done(t):
            nonlocal n_held
            r = fn(t)
            if r is not None and len(r[names[0]]):
                held.append(r)
                n_held += len(r[names[0]])

        def starts_of(t):
            change = np.zeros(t.num_rows, bool)
            change[0] = True
            for k in keys:
                col = t.column(k).to_numpy(zero_copy_only=False)
                change[1:] |= col[1:] != col[:-1]
            return np.flatnonzero(change)

        last = None
        for b in batches:
            if b.num_rows == 0:
                continue
            first = tuple(b.column(k)[0].as_py() for k in keys)
            t = pa.Table.from_batches([b])
            s = starts_of(t)
            if pend and first != last:
                done(pa.concat_tables(pend).combine_chunks())
                pend = []
            for i, a in enumerate(s):
                e = s[i + 1] if i + 1 < len(s) else b.num_rows
                piece = t.slice(a, e - a)
                if i + 1 < len(s):
                    if pend:
                        done(pa.concat_tables([*pend, piece]).combine_chunks())
                        pend = []
                    else:
                        done(piece)
                else:
                    pend.append(piece)
            last = tuple(b.column(k)[b.num_rows - 1].as_py() for k in keys)
            if n_held > 20_000:
                yield flush()
        if pend:
            done(pa.concat_tables(pend).combine_chunks())
        if held:
            yield flush()

    parted = df if shuffled else df.repartition(n_partitions(df), *keys)
    return parted.sortWithinPartitions(*keys).mapInArrow(run, schema)


def heavy_keys(df: DataFrame, key: str, share: int) -> DataFrame:
    """Keys that hold more than 1/``share`` of the rows: fewer than ``share`` of them, whatever the data."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    total = df.agg(F.count(F.lit(1)).alias("__t"))
    return counts.join(F.broadcast(total), F.col("__n") * share > F.col("__t")).select(key)


def lookup_join(left: DataFrame, right: DataFrame, key: str, share: int = 2048, how: str = "inner") -> DataFrame:
    """Join (``inner`` or ``left``) to a table that is unique on ``key``, safe where a key is hot on the left.

    Rows of the hot keys (fewer than ``share``, so a bounded table) are broadcast; all the
    others go through a shuffled join in which no key can hold more than 1/``share`` of the rows.
    ``left`` is read three times, so callers pass a table rather than a long plan.
    """
    hot = F.broadcast(heavy_keys(left, key, share))  # one broadcast, used three times
    hot_right = right.join(hot, key, "left_semi")
    a = left.join(hot, key, "left_anti").join(right, key, how)
    b = left.join(hot, key, "left_semi").join(F.broadcast(hot_right), key, how)
    return a.unionByName(b)
