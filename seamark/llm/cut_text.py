"""Texts that were cut off (problem 10).

A backward character n-gram model over the whole corpus: for the contexts formed by the last k
characters before a position (k in ``ORDERS``) it counts how often a text, block or sentence ends
there and how often it goes on. Each text's own final context is then judged with its own end left out:
interpolated from short to long contexts, the log-odds of ending against continuing. Finished
sentences and sign-off lines are places where other texts end too; inside a word or sentence the
corpus only ever goes on. Marks of a cut ("...", "[cut]") are taken off before. The threshold is
the valley between the two modes of the log-odds of each language and source, kept within bounds.

Exact copies count once in the model. Counting runs inside Arrow batches on rolling hashes, with
sorted run lengths as the map-side combine. A Bloom filter over the final contexts, of 16 bits for
each, keeps contexts that no text ends in out of the shuffle. Orders are walked upward: a position
whose last 4 characters end no text cannot end one with its last 7, so each order looks only at the
positions that are left. A filter beyond ``MOST_BITS`` is made in slices by the last two characters,
one after the other, each counting its own contexts; so memory is bounded and no filter saturates.

Defined results: null, empty and blank texts are no case; a null language or source is a group of
its own; a repeated doc_id counts once.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamark.functions.dist import cut, lookup_join, map_groups

ORDERS = (2, 4, 7, 10, 13, 15, 16, 17, 18, 19, 20, 21, 22, 23, 24, 26, 28)
BITS_EACH, MOST_BITS = 16, 1 << 30  # of the filter: for each context, and in one slice
BLOCK = 1 << 18  # bits of the filter in one row while it is built
MARK = re.compile(r"(?:\s*(?:\[[^\[\]\n]{0,40}\]|<[^<>\n]{0,40}>|\((?:\.\.\.|…)\)|…|\.{3,}))+\s*$")
# Sentence terminators that a blank follows, those that need none, and closing marks.
STOPS = np.array([ord(x) for x in ".!?؟۔।॥։።။"], np.uint64)
WIDE_STOPS = np.array([ord(x) for x in "。！？｡"], np.uint64)
CLOSERS = np.array([ord(x) for x in '"\')]}”’»'], np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)


def trimmed(text: str) -> str:
    """The text without outer blanks at its end, marks of a cut and zero-width characters there."""
    t = text.rstrip().rstrip("​﻿⁠").rstrip()
    if t[-1:] in "]>)….":
        cut_at = MARK.search(t, max(0, len(t) - 200))
        if cut_at and t[cut_at.start() : cut_at.end()].strip() not in (".", ")"):
            t = t[: cut_at.start()].rstrip()
    return t


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, digits as one, and the end offset of each text."""
    ends = np.cumsum([len(t) for t in texts])
    c = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    c[(c >= 48) & (c <= 57)] = 48
    return c, ends


def _hashes(c: np.ndarray):
    """A function of k and positions: hashes of the windows of k characters that end there."""
    with np.errstate(over="ignore"):
        powers = np.multiply.accumulate(np.full(len(c) + 1, _BASE, np.uint64))
        back = np.multiply.accumulate(np.full(len(c) + 1, _BACK, np.uint64))
        x = c * _MIX
        x ^= x >> np.uint64(29)
        sums = np.concatenate([[np.uint64(0)], np.add.accumulate(x * powers[: len(c)])])

        def of(k: int, last: np.ndarray) -> np.ndarray:
            first = last - (k - 1)
            h = (sums[last + 1] - sums[first]) * back[first]  # back to the exponents of a text's first window
            h ^= h >> np.uint64(32)
            return (h * _MIX) & ~np.uint64(1)

        return of


def _within(ends: np.ndarray) -> np.ndarray:
    """The place of each character in its text."""
    starts = np.concatenate([[0], ends[:-1]])
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(starts, ends - starts)


def _slice(two: np.ndarray, n_slices: int) -> np.ndarray:
    """The slice of contexts by the hash of their last two characters."""
    return (two >> np.uint64(40)) % np.uint64(n_slices)


def _stops(c: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where a reader may stop: the end of a text, of a block, of a list line, or of a sentence."""
    nxt, nxt2 = np.append(c[1:], 10), np.append(c[2:], [10, 10])
    stop = np.zeros(len(c), bool)
    stop[ends - 1] = True
    stop |= (nxt == 10) & ((nxt2 == 10) | (nxt2 == 45))
    blank = (nxt == 32) | (nxt == 10) | (nxt == 13)
    closed = np.isin(c, CLOSERS) & np.isin(np.append(0, c[:-1]), STOPS)
    return stop | (np.isin(c, WIDE_STOPS)) | ((np.isin(c, STOPS) | closed) & blank)


def finals(texts: DataFrame) -> DataFrame:
    """``key, order, h, two``: the final contexts of each text (``key, body``), and the hash of its last two characters."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            keys, bodies = b.column("key").to_pylist(), b.column("body").to_pylist()
            c, ends = _codes([t[-max(ORDERS) :] for t in bodies])
            of, last, size = _hashes(c), ends - 1, np.diff(np.concatenate([[0], ends]))
            out = []
            for k in ORDERS:
                i = np.flatnonzero(size >= k)
                out.append((i, np.full(len(i), k), of(k, last[i]), of(ORDERS[0], last[i])))
            i, order, h, two = (np.concatenate([o[n] for o in out]) for n in range(4))
            yield pa.RecordBatch.from_arrays([pa.array([keys[j] for j in i], pa.string()), pa.array(order, pa.int32()), pa.array(h.view(np.int64)), pa.array(two.view(np.int64))], names=["key", "order", "h", "two"])

    return texts.select("key", "body").mapInArrow(run, "key string, order int, h bigint, two bigint")


def bloom(contexts: DataFrame, size: int, which: int = 0, n_slices: int = 1) -> np.ndarray:
    """The filter of ``size`` bits over ``h`` of one slice, built in blocks on the executors."""

    def run(batches):
        bits = np.zeros(size // 8, np.uint8)
        for b in batches:
            h, two = (b.column(c).to_numpy().view(np.uint64) for c in ("h", "two"))
            at = (h[_slice(two, n_slices) == which] >> np.uint64(20)) % np.uint64(size)
            np.bitwise_or.at(bits, (at >> np.uint64(3)).astype(np.int64), (1 << (at & np.uint64(7))).astype(np.uint8))
        blocks = bits.reshape(-1, BLOCK // 8)
        some = np.flatnonzero(blocks.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([blocks[i].tobytes() for i in some], pa.binary())], names=["block", "bits"])

    def union(t: pa.Table):
        rows = [np.frombuffer(x, np.uint8) for x in t.column("bits").to_pylist()]
        return {"block": t.column("block").to_pylist()[:1], "bits": [np.bitwise_or.reduce(rows).tobytes()]}

    parts = contexts.select("h", "two").mapInArrow(run, "block int, bits binary")
    whole = np.zeros((size // BLOCK, BLOCK // 8), np.uint8)
    for r in map_groups(parts, ["block"], union, "block int, bits binary").toLocalIterator():
        whole[r["block"]] = np.frombuffer(r["bits"], np.uint8)
    return whole.reshape(-1)


def count_contexts(texts: DataFrame, bits: np.ndarray, which: int = 0, n_slices: int = 1, chars: int = 2_000_000) -> DataFrame:
    """``order, h, n, ends`` over every position of every text, for one slice: seen, and ended there."""
    size = np.uint64(len(bits) * 8)
    shared = texts.sparkSession.sparkContext.broadcast(bits)

    def tally(bodies):
        filt = shared.value
        c, ends = _codes(bodies)
        within, stop, of = _within(ends), _stops(c, ends), _hashes(c)
        pos = np.flatnonzero(within >= ORDERS[0] - 1)
        if n_slices > 1:
            pos = pos[_slice(of(ORDERS[0], pos), n_slices) == which]
        for k in ORDERS:
            pos = pos[within[pos] >= k - 1]
            h = of(k, pos)
            at = (h >> np.uint64(20)) % size
            keep = ((filt[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
            pos = pos[keep]
            if not len(pos):
                return
            keys = np.sort(h[keep] | stop[pos].astype(np.uint64))
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            n = np.diff(np.concatenate([first, [len(keys)]]))
            e = (keys[first] & np.uint64(1)).astype(np.int64) * n
            u = (keys[first] & ~np.uint64(1)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(u), k), pa.int32()), pa.array(u), pa.array(n, pa.int64()), pa.array(e, pa.int64())], names=["order", "h", "n", "ends"])

    def run(batches):
        held, size = [], 0
        for b in batches:
            for t in b.column("body").to_pylist():
                held.append(t)
                size += len(t)
                if size >= chars:
                    yield from tally(held)
                    held, size = [], 0
        if held:
            yield from tally(held)

    return texts.select("body").mapInArrow(run, "order int, h bigint, n bigint, ends bigint").groupBy("order", "h").agg(F.sum("n").alias("n"), F.sum("ends").alias("ends"))


def log_odds(texts: DataFrame, prior: float = 0.01, weight: float = 1.5, most_bits: int = MOST_BITS) -> DataFrame:
    """``key, odds``: for each text (``key, body``, unique) log-odds that it ends where it does."""
    ends = cut(finals(texts))
    n = ends.agg(F.approx_count_distinct("h", 0.02)).first()[0]
    n_slices = max(1, -(-n * BITS_EACH // most_bits))
    size = max(BLOCK, 1 << max(0, n * BITS_EACH // n_slices - 1).bit_length())
    made = (count_contexts(texts, bloom(ends, size, i, n_slices), i, n_slices) for i in range(n_slices))
    # Of several slices each is counted before the next filter is made.
    counts = next(made) if n_slices == 1 else reduce(DataFrame.unionByName, [cut(x) for x in made])
    seen = ends.join(counts, ["order", "h"])
    per = seen.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("order", (F.col("n") - 1).alias("n"), (F.col("ends") - 1).alias("e")))).alias("s"))
    p = F.aggregate("s", F.lit(prior), lambda acc, x: (x["e"] + weight * acc) / (x["n"] + weight))
    p = F.least(p, F.lit(1 - 1e-9))
    return per.select("key", F.log(p / (1 - p)).alias("odds"))


def _valley(odds: np.ndarray, low: float, high: float, start: float) -> float:
    """The middle of the widest gap of the histogram between ``low`` and ``high``; ``start`` where it is empty."""
    inside = np.sort(odds[(odds >= low) & (odds <= high)])
    edges = np.concatenate([[low], inside, [high]])
    gaps = np.diff(edges)
    i = int(gaps.argmax())
    return start if len(inside) == 0 else float((edges[i] + edges[i + 1]) / 2)


def cut_documents(docs: DataFrame, low: float = -5.0, high: float = -1.5, start: float = -2.8) -> DataFrame:
    """``doc_id, source, lang, odds, is_cut`` for each document with text."""

    def body(batches):
        for b in batches:
            t = [trimmed(x) for x in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "source", "lang", "key")), pa.array(t, pa.string())], names=["doc_id", "source", "lang", "key", "body"])

    d = docs.select("doc_id", "text", F.coalesce("source", F.lit("")).alias("source"), F.lower(F.coalesce("lang", F.lit("und"))).alias("lang"))
    d = d.where("doc_id IS NOT NULL AND text IS NOT NULL").dropDuplicates(["doc_id"]).withColumn("key", F.sha2("text", 256))
    d = cut(d.select("doc_id", "source", "lang", "key", "text").mapInArrow(body, "doc_id bigint, source string, lang string, key string, body string").where("body <> ''"))
    texts = cut(d.groupBy("key").agg(F.first("body").alias("body")), spread=True)
    scored = cut(lookup_join(d.drop("body"), log_odds(texts), "key"))
    # Thresholds from histograms of the log-odds: a bounded number of bins for each group.
    bins = scored.groupBy("lang", "source", F.round(F.col("odds") * 20).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))

    def valley(t: pa.Table):
        return {"lang": t.column("lang").to_pylist()[:1], "source": t.column("source").to_pylist()[:1], "limit": [_valley(t.column("bin").to_numpy() / 20, low, high, start)]}

    limits = map_groups(bins, ["lang", "source"], valley, "lang string, source string, limit double")
    return scored.join(limits, ["lang", "source"]).select("doc_id", "source", "lang", "odds", (F.col("odds") < F.col("limit")).alias("is_cut"))
