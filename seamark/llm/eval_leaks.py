"""Evaluation passages inside training text (problem 9).

Both sides are brought to one form (look-alike letters, widths and invisible characters unified,
case and punctuation dropped); in scripts that write no blanks each character is a word. Equal
texts form one class on either side, so copies are aligned once. Seeds are word trigrams of the
items: those that few items share, and as many commoner ones as it takes until the words outside
all seeds of an item hold at most a fifth of its weight (a word weighs what it is rare among the
items). A passage that counts holds more than twice that, so it always has seeds, however many
items or documents share it. Documents meet the items on seeds, and each pair with two seeds (all,
where an item has fewer) that hold at least 0.06 of the item's weight (a passage that counts keeps 0.1
in them even if every fourth word is changed) is aligned by Smith-Waterman over words.

A local alignment is taken, masked and taken again until none of ``min_run`` matches is left, so a
passage in several pieces counts whole. A document holds an item when the aligned passages match at
least ``min_cover`` of the item's words and, so that stock phrases alone never suffice,
``min_rare_cover`` of their weight.

The items' seeds are broadcast below ``broadcast_rows`` of them; above, they are joined with a
shuffle in which only hot seeds are broadcast. Both ways give the same rows.

Defined results: null, empty or blank texts on either side hold nothing; an item of fewer than
three words has no seed and is never found; repeated rows count once; of an id with several texts
each counts; items of equal words are found together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamark.functions.dist import cut, lookup_join, n_partitions
from seamark.llm.unify_text import unify

N = 3
MIN_RUN = 5
OUTSIDE, LEAST_SHARED = 0.2, 0.06
# Thai, Lao, Burmese, Khmer, kana and Han, as ranges: the JVM tests scripts slowly.
NO_BLANKS = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}"


def words_of(df: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """``t, words`` of each distinct text in one consistent form, and ``id, t`` of each row."""
    base = df.select(F.col(id_col).alias("id"), "text").where("id IS NOT NULL AND text IS NOT NULL").withColumn("t", F.sha2("text", 256))
    texts = unify(base.groupBy("t").agg(F.first("text").alias("text")))
    low = F.lower("unified")
    apart = F.when(low.rlike(f"[{NO_BLANKS}]"), F.regexp_replace(low, f"([{NO_BLANKS}])", " $1 ")).otherwise(low)
    words = texts.select("t", F.regexp_extract_all(apart, F.lit(r"[\p{L}\p{M}\p{N}]+"), F.lit(0)).alias("words")).where(f"size(words) >= {N}")
    return words, base.select("id", "t").distinct()


def grams(n: int = N):
    return F.transform(F.sequence(F.lit(0), F.size("words") - n), lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(n)]))


def seeds_of(words: DataFrame) -> DataFrame:
    """``t, seed``: the distinct word trigrams of each text, hashed."""
    return words.select("t", F.explode(F.array_distinct(grams())).alias("seed"))


def kept_seeds(seeds: list[tuple[int, int, int]], weights: list[float], max_items: int) -> dict[int, float]:
    """Of an item's seeds (position, seed, how many items share it) those to search by, with their share of the
    item's weight: all that at most ``max_items`` share, then commoner ones, ties together, until little weight is
    left outside."""
    w = np.array(weights)
    outside = np.ones(len(w), bool)
    out, level = {}, 0
    for pos, seed, n in sorted(seeds, key=lambda x: x[2]):
        if n > max_items and n > level and w[outside].sum() <= OUTSIDE * w.sum():
            break
        level = n
        outside[pos : pos + N] = False
        out[seed] = float(w[pos : pos + N].mean() / w.sum())
    return out


def align(doc: np.ndarray, item: np.ndarray, match: float = 2.0, miss: float = -3.0, gap: float = -2.0) -> np.ndarray:
    """Positions of ``item`` matched in the best local alignment (Smith-Waterman, linear gaps)."""
    n, m = len(item), len(doc)
    h = np.zeros((n + 1, m + 1), np.float32)
    steps = np.arange(m + 1, dtype=np.float32) * gap
    sub = np.where(item[:, None] == doc[None, :], np.float32(match), np.float32(miss))
    for i in range(1, n + 1):
        row = np.maximum(0, h[i - 1] + gap)
        row[1:] = np.maximum(row[1:], h[i - 1, :-1] + sub[i - 1])
        h[i] = np.maximum.accumulate(row - steps) + steps  # gaps along the document, all at once
    i, j = np.unravel_index(int(h.argmax()), h.shape)
    hit = []
    while i > 0 and j > 0 and h[i, j] > 0:
        if abs(h[i, j] - (h[i - 1, j - 1] + sub[i - 1, j - 1])) < 1e-3:
            i, j = i - 1, j - 1
            if sub[i, j] > 0:
                hit.append((i, j))
        elif abs(h[i, j] - (h[i - 1, j] + gap)) < 1e-3:
            i -= 1
        else:
            j -= 1
    return np.array(hit, int).reshape(-1, 2)


def covered(doc: list[str], item: list[str], weights: list[float], least: float = 0.0, least_rare: float = 0.0) -> tuple[float, float]:
    """Share of the item's words, and of their weights, in local alignments of ``MIN_RUN`` matches or
    more (of short items, half of their words); zeros where the common words alone show that
    ``least`` or ``least_rare`` cannot be reached."""
    code: dict[str, int] = {}
    it = np.array([code.setdefault(w, len(code)) for w in item], np.int64)
    d = np.array([code.get(w, -1) for w in doc], np.int64)
    w = np.array(weights)
    near = np.flatnonzero(d >= 0)
    present = np.isin(it, d[near])
    min_run = min(MIN_RUN, max(N, -(-len(item) // 2)))
    if present.sum() < max(min_run, least * len(it)) or w[present].sum() < least_rare * w.sum():
        return 0.0, 0.0
    # Words far from any of the item's cannot be in an alignment: keep the stretches around shared words.
    step = np.zeros(len(d) + 1, np.int64)
    np.add.at(step, np.maximum(near - len(it), 0), 1)
    np.add.at(step, np.minimum(near + len(it) + 1, len(d)), -1)
    d = d[np.cumsum(step)[:-1] > 0]
    total, weight = 0, 0.0
    while True:
        hit = align(d, it)
        if len(hit) < min_run:
            return total / len(item), weight / w.sum()
        total += len(hit)
        weight += w[hit[:, 0]].sum()
        it[hit[:, 0]] = -2 - hit[:, 0]
        d[hit[:, 1].min() : hit[:, 1].max() + 1] = -1


def leaks(docs: DataFrame, items: DataFrame, min_cover: float = 0.5, slack: float = 0.06, min_rare_cover: float = 0.42, min_seeds: int = 2, max_items: int = 3, broadcast_rows: int = 200_000) -> DataFrame:
    """``doc_id, item_id, cover`` of every document that holds a passage of an item.

    ``slack`` is allowed for the words that a light edit changes inside a copied passage.
    """
    d, doc_ids = words_of(docs, "doc_id")
    d = cut(d)
    it, item_ids = words_of(items, "item_id")
    # Items of the same words are one.
    it = cut(it.withColumn("k", F.sha2(F.array_join("words", " "), 256)))
    item_ids = cut(item_ids.join(it.select("t", "k"), "t").select("id", "k").distinct())
    it = it.groupBy("k").agg(F.first("words").alias("words")).select(F.col("k").alias("item"), "words")
    # A word's weight: how few of the items have it. Stock words of the items weigh next to nothing.
    n_items = it.count()
    df = it.select(F.explode(F.array_distinct("words")).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("df"))
    weighted = it.select("item", F.posexplode("words").alias("pos", "w")).join(df, "w").groupBy("item").agg(F.array_sort(F.collect_list(F.struct("pos", "w", F.log(F.lit(n_items + 1.0) / F.col("df")).alias("idf")))).alias("s"))
    weighted = cut(weighted.select("item", F.transform("s", lambda x: x["w"]).alias("iw"), F.transform("s", lambda x: x["idf"]).alias("idf")))

    placed = it.select("item", F.posexplode(grams()).alias("pos", "seed"))
    shared = placed.groupBy("seed").agg(F.count_distinct("item").alias("n"))
    per = placed.join(shared, "seed").groupBy("item").agg(F.collect_list(F.struct("pos", "seed", "n")).alias("seeds")).join(weighted.select("item", "idf"), "item")

    def choose(batches):
        for b in batches:
            rows = [(r["item"], kept_seeds([(x["pos"], x["seed"], x["n"]) for x in r["seeds"]], r["idf"], max_items)) for r in b.to_pylist()]
            flat = [(i, s, min(min_seeds, len(ss)), x) for i, ss in rows for s, x in ss.items()]
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in flat], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int32(), pa.float64()))], names=["item", "seed", "need", "weight"])

    seeds = cut(per.select("item", "seeds", "idf").mapInArrow(choose, "item string, seed bigint, need int, weight double"))
    if seeds.count() <= broadcast_rows:
        hits = seeds_of(d).join(F.broadcast(seeds), "seed")
    else:
        by_seed = seeds.groupBy("seed").agg(F.collect_list(F.struct("item", "need", "weight")).alias("items"))
        hits = lookup_join(cut(seeds_of(d)), by_seed, "seed").select("t", F.explode("items").alias("x")).select("t", "x.*")
    pairs = hits.groupBy("t", "item").agg(F.count(F.lit(1)).alias("n"), F.first("need").alias("need"), F.sum("weight").alias("weight")).where(f"n >= need AND weight >= {LEAST_SHARED}").select("t", "item")
    both = lookup_join(cut(pairs), weighted, "item").join(d.select("t", F.col("words").alias("dw")), "t")
    least = min_cover - slack

    def run(batches):
        for b in batches:
            t = {c: b.column(c).to_pylist() for c in ("dw", "iw", "idf")}
            got = [covered(*x, least, min_rare_cover) for x in zip(t["dw"], t["iw"], t["idf"], strict=True)]
            cover, rare_cover = (pa.array([g[k] for g in got], pa.float64()) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([b.column("t"), b.column("item"), cover, rare_cover], names=["t", "item", "cover", "rare_cover"])

    scored = both.select("t", "item", "dw", "iw", "idf").repartition(n_partitions(docs)).mapInArrow(run, "t string, item string, cover double, rare_cover double")
    found = scored.where((F.col("cover") >= least) & (F.col("rare_cover") >= min_rare_cover)).join(item_ids.withColumnRenamed("k", "item").groupBy("item").agg(F.collect_list("id").alias("ids")), "item")
    by_text = cut(found.groupBy("t").agg(F.collect_list(F.struct("ids", "cover")).alias("found")))
    rows = lookup_join(cut(doc_ids.join(by_text.select("t"), "t", "left_semi")), by_text, "t")
    rows = rows.select(F.col("id").alias("doc_id"), F.explode("found").alias("f")).select("doc_id", F.explode("f.ids").alias("item_id"), "f.cover")
    return rows.groupBy("doc_id", "item_id").agg(F.max("cover").alias("cover"))
