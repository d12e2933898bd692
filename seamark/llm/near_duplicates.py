"""Records that are the same but for small edits (problem 7).

Each distinct set of words gets min-hashes. One bit of each of the first ``BITS`` makes its
fingerprint, so that two sets of similarity s differ in (1-s)/2 of its bits. Runs of min-hashes make
the keys of sections; a section spreads the index over the cluster, one copy of a record in each, and
only records with an equal key meet. Every group of a key is an index of its own: its codes (the first
64 bits) are sorted by Gray rank, so that neighbours share long bit patterns; runs of the order are
leaves, and each upper node keeps the mask and pattern of the bits all its codes share. A search walks
the upper nodes with the difference to their patterns accumulated, prunes the group when more bits
differ than the similarity allows, and tests the whole fingerprints of the rest. Groups of up to a leaf
are compared row by row, many groups at once. Crowded groups are cut into cells that meet in pairs.
Pairs found are then checked on their exact sets of words.

The number of min-hashes in a key follows from the number of records and from how alike records are in
a sample (``plan_of``): keys get longer as records grow, so that those who meet by chance stay few, and
as many sections are taken as keep the chance to meet. Two sets of similarity 0.7 meet in at least one
section with probability 0.994, more similar ones nearly always (``tests/llm`` measures recall against
brute force).

Defined results: null texts and texts of fewer than ``min_words`` words take no part; records
with the same set of words form one class, which is opened to its members at the end; repeated
rows count once; an empty table gives no pairs.
"""

from __future__ import annotations

import gc
import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamark.functions.dist import cut, discard, lookup_join, n_partitions

WIDTHS = (24, 32, 40, 48)
CHANCE, MISS = 3000, 0.006
LEAST, MOST = 3, 9  # min-hashes in a key
BITS = 256
FP = [f"f{k}" for k in range(BITS // 64)]
LEAF = 64
SEED = 20_011
#: Means of the similarity of two records and of its powers, of narrative texts; ``likeness`` measures them.
ALIKE = (0.1, 0.012, 0.0015, 0.0002)
SAMPLE = 1000
CROWDED = 100_000


def gray_rank(code: np.ndarray) -> np.ndarray:
    """The place of each code in the order in which neighbours differ in one bit."""
    r = code.copy()
    for s in (1, 2, 4, 8, 16, 32)[: 5 if r.dtype.itemsize == 4 else 6]:
        r ^= r >> r.dtype.type(s)
    return r


def _sections(hashes: int, similarity: float) -> int:
    """Keys of ``hashes`` min-hashes that miss a pair with probability ``MISS``, 16 at least."""
    meet = similarity**hashes
    return 16 if meet >= 1 else max(16, math.ceil(math.log(MISS) / math.log(1 - meet)))


def hashes_of(sections: int, similarity: float) -> int:
    """The most min-hashes in a key with which so many sections still meet."""
    return max((h for h in range(1, MOST + 1) if _sections(h, similarity) <= sections), default=1)


def plan_of(n: int, similarity: float, alike: tuple[float, ...] = ALIKE) -> tuple[int, int]:
    """Sections and bits of a key for ``n`` records: the shortest keys that ``CHANCE`` others at most share
    without being similar, in as many bits as keep keys apart. ``alike``: means of the powers of the similarity."""
    fall = alike[-1] / alike[-2] if alike[-2] else 0.0
    mean = [*alike, *(alike[-1] * fall**k for k in range(1, MOST))]
    hashes = next((h for h in range(LEAST, MOST) if n * mean[h - 1] <= CHANCE), MOST)
    return _sections(hashes, similarity), next((w for w in WIDTHS[:-1] if 8 * n <= 2**w), WIDTHS[-1])


class GrayIndex:
    """Codes in Gray order under two levels of nodes that hold their groups' shared bits."""

    def __init__(self, codes: np.ndarray, leaf: int = LEAF):
        self.order = np.argsort(gray_rank(codes), kind="stable")
        self.codes = codes[self.order]
        self.levels = []
        for width in (leaf * leaf, leaf):
            starts = np.arange(0, len(codes), width)
            ones = np.bitwise_and.reduceat(self.codes, starts)
            any_one = np.bitwise_or.reduceat(self.codes, starts)
            self.levels.append((starts, ~(any_one ^ ones), ones))
        self.leaf = leaf

    def parts(self, radius: int):
        """All (i, j), i before j in Gray order, within ``radius`` bits; found leaf against leaf, a leaf's pairs at a time."""
        (_, top_mask, top_bits), (starts, mask, bits) = self.levels
        for x in range(len(starts)):
            # Differences to a group are at least those on the bits both groups share.
            t = np.bitwise_count((bits[x] ^ top_bits) & mask[x] & top_mask) <= radius
            t[: x // self.leaf] = False
            nodes = (np.flatnonzero(t)[:, None] * self.leaf + np.arange(self.leaf)[None]).ravel()
            nodes = nodes[(nodes >= x) & (nodes < len(starts))]
            nodes = nodes[np.bitwise_count((bits[x] ^ bits[nodes]) & mask[x] & mask[nodes]) <= radius]
            mine = np.arange(starts[x], min(starts[x] + self.leaf, len(self.codes)))
            cand = (starts[nodes][:, None] + np.arange(self.leaf)[None]).ravel()
            cand = cand[cand < len(self.codes)]
            i, j = np.divmod(np.flatnonzero(np.bitwise_count(self.codes[mine][:, None] ^ self.codes[cand][None]) <= radius), max(1, len(cand)))
            keep = mine[i] < cand[j]
            yield self.order[mine[i][keep]], self.order[cand[j][keep]]

    def pairs(self, radius: int) -> tuple[np.ndarray, np.ndarray]:
        left, right = zip(*self.parts(radius), strict=True)
        return np.concatenate(left), np.concatenate(right)


def min_hashes(words: pa.Array, n: int, chunk: int = 1_000) -> np.ndarray:
    """``n`` min-hashes of each text's words, which single blanks part, as rows of uint32."""
    lists = pc.split_pattern(words, " ")
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    each = lists.flatten().dictionary_encode()
    h = np.array([zlib.crc32(w.encode()) for w in each.dictionary.to_pylist()], np.uint32)
    rng = np.random.default_rng(SEED)
    mul = rng.integers(1 << 31, size=n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    add = rng.integers(1 << 32, size=n, dtype=np.uint32)
    with np.errstate(over="ignore"):
        for shift, by in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
            h = (h ^ (h >> np.uint32(shift))) * np.uint32(by)
    h = (h ^ (h >> np.uint32(16)))[each.indices.to_numpy()]
    sizes = pc.list_value_length(lists).to_numpy()
    ends = np.cumsum(sizes, dtype=np.int64)
    out = np.empty((len(sizes), n), np.uint32)
    row = 0
    while row < len(sizes):
        base = ends[row] - sizes[row]
        stop = max(row + 1, int(np.searchsorted(ends, base + chunk, side="right")))
        v = h[base : ends[stop - 1], None] * mul[None]
        v += add
        out[row:stop] = np.minimum.reduceat(v, ends[row:stop] - sizes[row:stop] - base, axis=0)
        row = stop
    return out


def _mixed(v: np.ndarray) -> np.ndarray:
    for by in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        v = (v ^ (v >> np.uint64(31))) * np.uint64(by)
    return v ^ (v >> np.uint64(31))


def dealt(low: np.ndarray, sections: int, hashes: int) -> list[int]:
    """Which min-hash stands where in the keys. Some meet in words that many records have, also together: they are dealt
    out so that few pairs of a sample share a key, else a key made of several of them holds a good part of all records."""
    x, y = np.triu_indices(len(low), 1)
    shared = np.stack([np.packbits(low[x, k] == low[y, k]) for k in range(sections * hashes)])
    shared = np.pad(shared, ((0, 0), (0, -shared.shape[1] % 8))).view(np.uint64)
    order = np.argsort(-np.bitwise_count(shared).sum(1, dtype=np.int64), kind="stable")
    out = np.empty((sections, hashes), np.int64)
    out[:, 0] = order[:sections]
    both = shared[out[:, 0]]
    for k in range(1, hashes):
        rest = order[k * sections : (k + 1) * sections].tolist()
        for s in np.argsort(-np.bitwise_count(both).sum(1, dtype=np.int64), kind="stable"):
            best = rest.pop(int(np.bitwise_count(both[s] & shared[rest]).sum(1, dtype=np.int64).argmin()))
            out[s, k] = best
            both[s] &= shared[best]
    return out.ravel().tolist()


def likeness(low: np.ndarray) -> tuple[float, ...]:
    """Means, over the pairs of a sample's min-hashes, of the similarity and of its first powers."""
    n, m = low.shape
    if n < 2:
        return ALIKE
    equal = np.zeros(m + 1, np.int64)
    for x in range(n - 1):
        equal += np.bincount((low[x + 1 :] == low[x]).sum(1), minlength=m + 1)
    k = np.arange(m + 1)
    # Of k equal ones among m, so many choices of h are all equal: no bias by chance.
    return tuple(float((equal * np.prod([(k - i) / (m - i) for i in range(h)], 0)).sum() / equal.sum()) for h in range(1, len(ALIKE) + 1))


def word_sets(df: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """``id, words, k`` of each row of ``min_words`` words or more: its sorted distinct words with single blanks, and their digest."""
    base = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    # A word and a blank each, but for the last one's blank: shorter texts need not leave the JVM.
    base = base.where(F.length("text") >= 2 * min_words - 1)
    kind = base.schema["id"].dataType.simpleString()

    def sets(batches):
        kept = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
        looks = bytes(x if x in kept else 32 for x in range(256)).lower()
        for b in batches:
            at, out = [], []
            for i, text in enumerate(b.column("text").cast(pa.binary()).to_pylist()):
                w = text.translate(looks).split()
                if len(w) >= min_words:
                    at.append(i)
                    out.append(b" ".join(sorted(set(w))))
            k = pa.array([hashlib.sha256(x).digest() for x in out], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(at, pa.int64())), pa.array(out, pa.binary()).cast(pa.string()), k], names=["id", "words", "k"])

    return base.mapInArrow(sets, f"id {kind}, words string, k binary")


def _free(df: DataFrame) -> None:
    """Shuffle files that no plan holds any more go when the driver collects its garbage: now, not some time later."""
    gc.collect()
    df.sparkSession._jvm.System.gc()


def classes_of(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``c, rep, words`` for each distinct set (``rep`` its smallest id) and ``id, c`` for each record."""
    rows = cut(sets)
    of = cut(rows.groupBy("id").agg(F.min("k").alias("k")))
    one = of.groupBy("k").agg(F.min("id").alias("rep")).join(rows.select("k", "words").dropDuplicates(["k"]), "k")
    one = cut(one.withColumn("c", F.monotonically_increasing_id()))
    discard(rows)
    _free(one)
    return one.select("c", "rep", "words"), of.join(one.select("k", "c"), "k").select("id", "c")


def entries(classes: DataFrame, sections: int, width: int, at_key: list[int]) -> DataFrame:
    """``key, c, f0, f1, ...``: each class once in each section, with its fingerprint. ``at_key``: the min-hashes of the keys."""
    n, hashes = max(len(at_key), BITS), len(at_key) // sections

    def spread(batches):
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                low = min_hashes(part.column("words"), n)
                fp = np.packbits((low[:, :BITS] >> np.uint32(9)).astype(np.uint8) & 1, axis=1, bitorder="little").view(np.int64)
                keys = np.empty((sections, part.num_rows), np.uint64)
                for s in range(sections):
                    v = np.full(part.num_rows, s, np.uint64)
                    for x in at_key[s * hashes : (s + 1) * hashes]:
                        v = _mixed(v + low[:, x])
                    keys[s] = (np.uint64(s) << np.uint64(width)) | (v >> np.uint64(64 - width))
                c = b.column("c").slice(at, 2000).to_numpy()
                cols = [keys.view(np.int64).T.ravel(), *(np.repeat(x, sections) for x in (c, *fp.T))]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=["key", "c", *FP])

    return classes.select("c", "words").mapInArrow(spread, "key bigint, c bigint, " + ", ".join(f"{f} bigint" for f in FP))


def _most(bits: int, similarity: float) -> int:
    """Of so many bits, how many differ at most."""
    near = 0.5 * (1 - similarity)
    return int(bits * near + 4 * (bits * near * (1 - near)) ** 0.5)


def near_rows(group: np.ndarray, fp: np.ndarray, similarity: float):
    """Arrays (i, j) of rows of one group whose fingerprints are near; rows of a group stand together."""
    first = _most(64, similarity)
    codes = np.ascontiguousarray(fp.T)

    def near(i, j):
        differ = 0
        for k, code in enumerate(codes):
            differ = differ + np.bitwise_count(code[i] ^ code[j]).astype(np.int64)
            ok = differ <= _most(64 * (k + 1), similarity)
            i, j, differ = i[ok], j[ok], differ[ok]
        return i, j

    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    to_end = np.repeat(starts + sizes, sizes) - np.arange(len(group))
    at = np.flatnonzero((np.repeat(sizes, sizes) <= LEAF) & (to_end > 1))
    for d in range(1, LEAF):
        at = at[to_end[at] > d]
        if not len(at):
            break
        yield near(at, at + d)
    for a, n in zip(starts[sizes > LEAF], sizes[sizes > LEAF], strict=True):
        for i, j in GrayIndex(codes[0, a : a + n]).parts(first):
            yield near(a + i, a + j)


def candidate_pairs(classes: DataFrame, similarity: float, block: int = 4096, plan: tuple[int, int] | None = None) -> DataFrame:
    """``a, b``: classes whose fingerprints agree as far as ``similarity`` demands."""
    n_classes = classes.count()
    some = pa.array([r.words for r in classes.orderBy(F.xxhash64("c")).limit(SAMPLE).select("words").collect()], pa.string())
    sections, width = plan or plan_of(n_classes, similarity, likeness(min_hashes(some, 128)))
    hashes = hashes_of(sections, similarity)
    at_key = dealt(min_hashes(some, sections * hashes), sections, hashes)
    e = entries(classes, sections, width, at_key)

    # Crowded keys are told by a share of the classes, and are fewer than CROWDED whatever the data.
    share = max(1, block // 64)
    most = max(block, n_classes * sections // CROWDED)
    counts = entries(classes.where(F.pmod(F.xxhash64("c"), F.lit(share)) == 0), sections, width, at_key).groupBy("key").agg((F.count(F.lit(1)) * share).alias("n"))
    cells = cut(counts.where(F.col("n") > most).select("key", F.ceil(F.col("n") / (4 * block)).cast("int").alias("cells")).where("cells > 1"))
    split = not cells.isEmpty()
    if split:
        e = e.join(F.broadcast(cells), "key", "left").withColumn("cells", F.coalesce("cells", F.lit(1)))
        e = e.withColumn("mine", F.pmod(F.xxhash64("c", F.lit(1)), F.col("cells")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
        e = e.select("key", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"), "mine", "c", *FP)
    keys = ["key", "p", "q"] if split else ["key"]

    def search(batches):
        held: list[pa.RecordBatch] = []

        def found(t: pa.Table):
            cols = [t.column(k).to_numpy() for k in keys]
            change = np.zeros(t.num_rows, bool)
            for x in cols:
                change[1:] |= x[1:] != x[:-1]
            fp = np.stack([t.column(f).to_numpy() for f in FP], 1).view(np.uint64)
            c = t.column("c").to_numpy()
            side, two = (t.column("mine").to_numpy(), cols[1] != cols[2]) if split else (None, None)
            for i, j in near_rows(np.cumsum(change), fp, similarity):
                if split:
                    ok = ~two[i] | (side[i] != side[j])
                    i, j = i[ok], j[ok]
                if len(i):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(c[i], c[j])), pa.array(np.maximum(c[i], c[j]))], names=["a", "b"])

        def packed(rows):
            """Few large batches instead of many small ones."""
            kept, n = [], 0
            for b in rows:
                kept.append(b)
                n += b.num_rows
                if n > 20_000:
                    yield from pa.Table.from_batches(kept).combine_chunks().to_batches()
                    kept, n = [], 0
            if kept:
                yield from pa.Table.from_batches(kept).combine_chunks().to_batches()

        def all_rows():
            for b in batches:
                if not b.num_rows:
                    continue
                same = np.ones(b.num_rows, bool)
                for k in keys:
                    x = b.column(k).to_numpy()
                    same &= x == x[-1]
                last = int(np.argmax(same))  # where the last group begins; it may go on
                if last or held and any(b.column(k)[0] != held[-1].column(k)[held[-1].num_rows - 1] for k in keys):
                    yield from found(pa.Table.from_batches([*held, b.slice(0, last)]).combine_chunks())
                    held.clear()
                held.append(b.slice(last))
            if held:
                yield from found(pa.Table.from_batches(held).combine_chunks())

        yield from packed(all_rows())

    return e.repartition(n_partitions(e), *keys).sortWithinPartitions(*keys).mapInArrow(search, "a bigint, b bigint").distinct()


def similar_classes(classes: DataFrame, similarity: float) -> DataFrame:
    """``a, b, similarity``: pairs of classes whose exact sets of words are similar enough."""
    pairs = cut(candidate_pairs(classes, similarity))
    _free(pairs)
    wa, wb = classes.select(F.col("c").alias("a"), F.col("words").alias("wa")), classes.select(F.col("c").alias("b"), F.col("words").alias("wb"))
    both = pairs.join(wa, "a").join(wb, "b").select("a", "b", F.split("wa", " ").alias("wa"), F.split("wb", " ").alias("wb"))
    common = F.size(F.array_intersect("wa", "wb"))
    sim = common / (F.size("wa") + F.size("wb") - common)
    return both.select("a", "b", sim.alias("similarity")).where(F.col("similarity") >= similarity)


def near_duplicates(df: DataFrame, id_col: str, text_col: str, similarity: float = 0.7, min_words: int = 20) -> tuple[DataFrame, DataFrame]:
    """Pairs of classes ``a, b, similarity`` and membership ``id, c``."""
    classes, members = classes_of(word_sets(df, id_col, text_col, min_words))
    return similar_classes(classes, similarity), members


def linked_classes(df: DataFrame, id_col: str, text_col: str, similarity: float = 0.7, min_words: int = 20) -> DataFrame:
    """``id, class_id, copies, n_links``: of each record the smallest id with the same set of words, the records
    that have it, and the number of other sets that are similar enough. One row for each record."""
    classes, members = classes_of(word_sets(df, id_col, text_col, min_words))
    pairs = cut(similar_classes(classes, similarity))
    links = pairs.select(F.explode(F.array("a", "b")).alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n_links"))
    m = cut(members)
    sizes = m.groupBy("c").agg(F.count(F.lit(1)).alias("copies"))
    told = classes.select("c", "rep").join(sizes, "c").join(links, "c", "left").select("c", F.col("rep").alias("class_id"), "copies", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return lookup_join(m, told, "c").select("id", "class_id", "copies", "n_links")


def near_duplicate_pairs(df: DataFrame, id_col: str, text_col: str, similarity: float = 0.7, min_words: int = 20) -> DataFrame:
    """``a, b``: all pairs of records, opened from the classes."""
    pairs, members = near_duplicates(df, id_col, text_col, similarity, min_words)
    m = cut(members)
    x, y = m.select(F.col("id").alias("x"), F.col("c").alias("a")), m.select(F.col("id").alias("y"), F.col("c").alias("b"))
    across = pairs.join(x, "a").join(y, "b").select("x", "y")
    several = m.groupBy("c").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("c")
    in_class = m.join(several, "c", "left_semi")
    inside = in_class.select("c", F.col("id").alias("x")).join(in_class.select("c", F.col("id").alias("y")), "c").where("x < y").select("x", "y")
    return across.unionByName(inside).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
