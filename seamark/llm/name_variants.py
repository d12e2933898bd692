"""Variant spellings of one person or organisation (problem 6).

Metric-space partitioning: the surname or leading name of every spelling is a point under edit
distance. Pivots from a bounded sample split the space into cells; a name goes to its nearest
pivot and, as the triangle inequality demands, to every other cell it could have a partner in:
d(x, pivot) <= d(x, own pivot) + 2 r, which loses no pair within radius r. The number of pivots and
the share of them that is so near are bounded, so a name has the same number of copies at every size
of the data. Inside a cell an exact radius join runs with bit-parallel Levenshtein distances behind
filters on length, pivot distance and letters. A crowded cell is split further by segments: of r + 1
segments of a name, one stands unchanged in each partner, at most r places away; this too copies each
name a fixed number of times, and the work grows with the data, not with its square.

Only distinct keys travel through the cells. Pairs of keys then meet their spellings on what has to
be equal (given name, initials, number of words), and the spellings are compared on their other
parts: given names with short forms and initials, middle initials, words of an organisation with
abbreviations, legal forms. A spelling with initials only is linked if all its full partners agree
on one name. Keys of one or two letters (organisations: three) match exactly, those up to six
letters within one edit, longer ones within two.

Groups are the components of the links between spellings and canonical ids; mention labels and
aliases add the spellings that belong to a canonical id.

Defined results: null ids, names and types are dropped; names without a usable part link to
nothing; other types than PERSON and ORGANIZATION take no part; repeated rows count once; names are
read whole, however long, in every script.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamark.functions.dist import cut, map_groups, n_partitions
from seamark.llm.components import components
from seamark.llm.name_parts import organization, osa, person, relation, segment_keys

RADIUS = 2
MOST_PIVOTS = 512
PIVOT_SAMPLE = 4096
OWN_BLOCK, OTHER_BLOCK = 2048, 65_536
FOLD = 0xFFF  # characters count as equal to a few far ones; that only lowers distances, and keeps them a metric
KINDS = ("PERSON", "ORGANIZATION")


def limit_of(kind: str, size: int, radius: int = RADIUS) -> int:
    """The edits allowed between two keys, the shorter one of ``size`` letters."""
    return 0 if size < (3 if kind == "PERSON" else 4) else 1 if size <= 6 else radius


def folded(name: str) -> np.ndarray:
    return np.frombuffer(name.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint16) & np.uint16(FOLD)


def letters(names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Folded characters of each name as a padded matrix, and the lengths."""
    size = np.array([len(n) for n in names], np.int64)
    out = np.zeros((len(names), max(1, int(size.max(initial=0)))), np.uint16)
    for i, n in enumerate(names):
        out[i, : len(n)] = folded(n)
    return out, size


def distances(pattern: str, texts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Levenshtein distance of ``pattern`` to each row of ``texts`` (Myers' bit vectors)."""
    m = len(pattern)
    if m == 0:
        return size.copy()
    if m > 64:  # beyond a machine word: row by row
        row = np.repeat(np.arange(m + 1)[None], len(texts), 0)
        out = np.where(size == 0, m, 0)
        p = folded(pattern)
        for j in range(texts.shape[1]):
            new = np.empty_like(row)
            new[:, 0] = j + 1
            for k in range(1, m + 1):
                new[:, k] = np.minimum(np.minimum(row[:, k], new[:, k - 1]) + 1, row[:, k - 1] + (texts[:, j] != p[k - 1]))
            row = new
            out = np.where(size == j + 1, row[:, m], out)
        return out
    table = np.zeros(FOLD + 1, np.uint64)
    for k, c in enumerate(folded(pattern)):
        table[c] |= np.uint64(1 << k)
    one, top = np.uint64(1), np.uint64(m - 1)
    pv, mv = np.full(len(texts), np.uint64(2**64 - 1)), np.zeros(len(texts), np.uint64)
    score = np.full(len(texts), m, np.int64)
    out = np.where(size == 0, m, 0)
    for j in range(texts.shape[1]):
        eq = table[texts[:, j]]
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | ~(xh | pv), pv & xh
        score += ((ph >> top) & one).astype(np.int64) - ((mh >> top) & one).astype(np.int64)
        ph, mh = (ph << one) | one, mh << one
        pv, mv = mh | ~(xv | ph), ph & xv
        out = np.where(size == j + 1, score, out)
    return out


def forms_of(names: DataFrame) -> DataFrame:
    """``kind, name, key, words, initials, extra``: the parts of each distinct ``kind, name``."""

    def run(batches):
        for b in batches:
            kinds, given = b.column("kind").to_pylist(), b.column("name").to_pylist()
            got = [(k, n, p) for k, n in zip(kinds, given, strict=True) if (p := (person if k == "PERSON" else organization)(n))]
            cols = [[g[0] for g in got], [g[1] for g in got], *([g[2][i] for g in got] for i in range(4))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], names=["kind", "name", "key", "words", "initials", "extra"])

    return names.select("kind", "name").distinct().repartition(n_partitions(names)).mapInArrow(run, "kind string, name string, key string, words string, initials string, extra string")


def key_pairs(keys: DataFrame, radius: int = RADIUS, own_block: int = OWN_BLOCK, other_block: int = OTHER_BLOCK) -> DataFrame:
    """``kind, ka, kb``: different keys (``kind, key``, distinct) within the edits allowed, each pair once."""
    sample = keys.select("key").distinct().orderBy(F.xxhash64("key")).limit(PIVOT_SAMPLE).toPandas()["key"].tolist()
    pivots = sample[: int(min(MOST_PIVOTS, max(4, keys.count() ** 0.5)))]

    def spread(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x, size = letters(b.column("key").to_pylist())
            d = np.stack([distances(p, x, size) for p in pivots], 1)
            home = d.argmin(1)
            r = np.array([limit_of(k, n, radius) for k, n in zip(b.column("kind").to_pylist(), size.tolist(), strict=True)])
            # A pair is found in the cell of the smaller home, so only cells before the own one need a copy.
            near = d <= (d.min(1) + 2 * r)[:, None]
            near &= np.arange(d.shape[1])[None, :] < home[:, None]
            i, cell = np.nonzero(near)
            rows, cells = np.concatenate([np.arange(len(x)), i]), np.concatenate([home, cell])
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(take) for c in ("kind", "key")), pa.array(cells, pa.int32()), pa.array(d[rows, cells], pa.int32()), pa.array(cells == home[rows])], names=["kind", "key", "cell", "d", "home"])

    e = cut(keys.select("kind", "key").mapInArrow(spread, "kind string, key string, cell int, d int, home boolean"))
    sizes = e.groupBy("kind", "cell").agg(F.count_if("home").alias("own"), F.count(F.lit(1)).alias("n"))
    sizes = cut(sizes.select("kind", "cell", ((F.col("own") > own_block) | (F.col("n") > other_block)).alias("crowded")))
    e = e.join(F.broadcast(sizes), ["kind", "cell"])  # at most two rows for each pivot

    def join(t: pa.Table):
        home = t.column("home").to_numpy(zero_copy_only=False)
        if not home.any():
            return None
        kind, names, d = t.column("kind")[0].as_py(), t.column("key").to_pylist(), t.column("d").to_numpy()
        x, size = letters(names)
        present = np.bitwise_or.reduce(np.where(x > 0, np.uint64(1) << (x % 64).astype(np.uint64), np.uint64(0)), axis=1)
        ka, kb = [], []
        for i in np.flatnonzero(home):
            some = np.flatnonzero((np.abs(size - size[i]) <= radius) & (np.abs(d - d[i]) <= radius) & (np.bitwise_count(present ^ present[i]) <= 2 * radius) & (~home | (np.arange(len(names)) > i)))
            if not len(some):
                continue
            got = distances(names[i], x[some], size[some])
            for k, n in zip(some[got <= radius], got[got <= radius], strict=True):
                if n <= limit_of(kind, min(size[i], size[k]), radius):
                    ka.append(min(names[i], names[k]))
                    kb.append(max(names[i], names[k]))
        return {"kind": [kind] * len(ka), "ka": ka, "kb": kb}

    plainly = map_groups(e.where("NOT crowded").select("kind", "cell", "key", "d", "home"), ["kind", "cell"], join, "kind string, ka string, kb string")

    def sign(batches):
        for b in batches:
            at, sig, waits = [], [], []
            for i, (kind, key) in enumerate(zip(b.column("kind").to_pylist(), b.column("key").to_pylist(), strict=True)):
                for w, ss in zip((True, False), segment_keys(key, lambda n, kind=kind: limit_of(kind, n, radius), radius), strict=True):
                    at += [i] * len(ss)
                    sig += ss
                    waits += [w] * len(ss)
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(at, pa.int64())) for c in ("kind", "key", "cell", "d", "home")), pa.array(sig, pa.string()), pa.array(waits, pa.bool_())], names=["kind", "key", "cell", "d", "home", "sig", "waits"])

    s = cut(e.where("crowded").select("kind", "key", "cell", "d", "home").mapInArrow(sign, "kind string, key string, cell int, d int, home boolean, sig string, waits boolean"))
    side = lambda w, p: s.where(F.col("waits") == w).select("kind", "cell", "sig", *(F.col(c).alias(p + c) for c in ("key", "d", "home")))
    met = side(True, "a_").join(side(False, "b_"), ["kind", "cell", "sig"]).where((F.col("a_key") != F.col("b_key")) & (F.col("a_home") | F.col("b_home")) & (F.abs(F.col("a_d") - F.col("b_d")) <= radius))
    least = F.least(F.length("a_key"), F.length("b_key"))
    short = F.when(F.col("kind") == "PERSON", 3).otherwise(4)
    edits = F.levenshtein("a_key", "b_key", radius)
    met = met.where((edits >= 0) & (edits <= F.when(least < short, 0).when(least <= 6, 1).otherwise(radius)))
    return plainly.unionByName(met.select("kind", F.least("a_key", "b_key").alias("ka"), F.greatest("a_key", "b_key").alias("kb"))).distinct()


def radius_links(forms: DataFrame, radius: int = RADIUS, own_block: int = OWN_BLOCK, other_block: int = OTHER_BLOCK) -> DataFrame:
    """``a, b, level``: forms (``f, kind, key, words, initials, extra``) that can be one name; level 2 by full
    parts, 1 by initials. Both are listed once, and ``wa``/``wb`` tell the full parts."""
    keys = cut(forms.select("kind", "key").distinct(), spread=True)
    pairs = cut(key_pairs(keys, radius, own_block, other_block).unionByName(keys.select("kind", F.col("key").alias("ka"), F.col("key").alias("kb"))))
    # What has to be equal: of two full names the given name, of two organisations the number of words;
    # beside initials only, the initials (of persons the first).
    first = F.when(F.col("kind") == "PERSON", F.substring("initials", 1, 1)).otherwise(F.col("initials"))
    full = F.when(F.col("kind") == "PERSON", F.col("words")).otherwise(F.size(F.split("words", " ")).cast("string"))
    part = ("f", "key", "words", "initials", "extra")

    def met(by, where_a: str, where_b: str) -> DataFrame:
        a = forms.where(where_a).select("kind", F.col("key").alias("ka"), by.alias("same"), *(F.col(c).alias("a_" + c) for c in part))
        b = forms.where(where_b).select("kind", F.col("key").alias("kb"), by.alias("same"), *(F.col(c).alias("b_" + c) for c in part))
        both = pairs.unionByName(pairs.where("ka <> kb").select("kind", F.col("kb").alias("ka"), F.col("ka").alias("kb")))
        return both.join(a, ["kind", "ka"]).join(b, ["kind", "kb", "same"]).where("a_f <> b_f")

    rows = met(full, "words <> ''", "words <> ''").where("a_f < b_f")
    rows = rows.unionByName(met(first, "words = ''", "words <> ''")).unionByName(met(first, "words = ''", "words = ''").where("a_f < b_f"))

    def agree(batches):
        for b in batches:
            level = []
            for r in b.to_pylist():
                x, y = (tuple(r[p + c] for c in part[1:]) for p in ("a_", "b_"))
                limit = limit_of(r["kind"], min(len(x[0]), len(y[0])), radius)
                edits = osa(x[0], y[0], limit)
                got = relation(r["kind"], x, y, edits, limit)
                level.append(got if got == 2 or edits <= 1 else 0)
            kept = pa.array([v > 0 for v in level], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("a_f").filter(kept), b.column("b_f").filter(kept), pa.array([v for v in level if v], pa.int32()), b.column("a_words").filter(kept), b.column("b_words").filter(kept)], names=["a", "b", "level", "wa", "wb"])

    cols = [p + c for p in ("a_", "b_") for c in part]
    return rows.select("kind", *cols).mapInArrow(agree, "a bigint, b bigint, level int, wa string, wb string")


def _agree(pairs: DataFrame) -> DataFrame:
    """Of ``cid, f`` beside the parts of an own and a further spelling, those that can be one name by full parts."""

    def run(batches):
        for b in batches:
            rows = b.to_pylist()
            keep = []
            for r in rows:
                x, y = ((r[p + "key"], r[p + "words"], r[p + "initials"], r[p + "extra"]) for p in ("", "o_"))
                keep.append(bool(r["words"]) and relation(r["kind"], x, y, osa(r["key"], r["o_key"], 3), 3) >= 1)
            yield b.select(["cid", "f"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("cid", "f", "kind", *(f"{p}{c}" for p in ("", "o_") for c in ("key", "words", "initials", "extra"))).mapInArrow(run, "cid string, f bigint").distinct()


def same_entities(mentions: DataFrame, linked: DataFrame) -> DataFrame:
    """``cid, group_id`` for every canonical id of a person or organisation."""
    usable = "cid IS NOT NULL AND name IS NOT NULL"
    base = linked.where(F.col("type").isin(*KINDS)).select(F.col("canonical_id").alias("cid"), F.col("type").alias("kind"), "name", "mention_ids")
    own_names = base.where(usable).select("cid", "kind", "name").distinct()
    heard = base.select("cid", "kind", F.explode("mention_ids").alias("mention_id")).where("cid IS NOT NULL AND mention_id IS NOT NULL").distinct()
    spelled = mentions.select("mention_id", F.explode(F.array_compact(F.concat(F.array("label"), F.coalesce("aliases", F.expr("cast(array() as array<string>)"))))).alias("name")).distinct()
    more_names = heard.join(spelled, "mention_id").select("cid", "kind", "name").distinct()
    parsed = cut(forms_of(own_names.select("kind", "name").unionByName(more_names.select("kind", "name"))))
    part = ["kind", "key", "words", "initials", "extra"]
    forms = cut(parsed.select(*part).distinct().withColumn("f", F.monotonically_increasing_id()), spread=True)
    named = cut(parsed.join(forms, part).select("kind", "name", "f", *part[1:]))
    own = cut(own_names.join(named, ["kind", "name"]).drop("name").distinct())
    further = more_names.join(named, ["kind", "name"]).drop("name").distinct().join(own.select("cid", "f"), ["cid", "f"], "left_anti")
    further = further.join(own.select("cid", *(F.col(c).alias(f"o_{c}") for c in part[1:])), "cid")
    alias = cut(_agree(further))
    links = cut(radius_links(forms))

    node = lambda c: F.concat(F.lit("f:"), F.col(c))
    edge = lambda df, x, y: df.select(x.alias("a"), y.alias("b"))
    full_own = own.where("words <> ''")
    full_ids = full_own.select("cid").distinct()
    sure = [edge(links.where("level = 2"), node("a"), node("b")), edge(full_own, F.col("cid"), node("f")), edge(alias.join(full_ids, "cid", "left_semi"), F.col("cid"), node("f"))]
    nobody = own.select(F.col("cid").alias("id")).where("false")
    groups = cut(components(nobody, reduce(DataFrame.unionByName, sure)))

    # Initials only: linked if all full partners are one group, or to each other if there is none.
    half = links.where("level = 1")
    to_full = half.where("wa = '' AND wb <> ''").select(F.col("a").alias("f"), F.col("b").alias("full")).unionByName(half.where("wb = '' AND wa <> ''").select(F.col("b").alias("f"), F.col("a").alias("full")))
    of = groups.select(F.col("id").alias("n"), "group_id")
    to_group = to_full.withColumn("n", node("full")).join(of, "n", "left").select("f", F.coalesce("group_id", "n").alias("g"))
    partner = cut(to_group.groupBy("f").agg(F.count_distinct("g").alias("n"), F.min("g").alias("g")))
    lone = forms.where("words = ''").select("f").join(partner, "f", "left_anti")
    both_lone = half.where("wa = '' AND wb = ''").select("a", "b").join(lone.withColumnRenamed("f", "a"), "a", "left_semi").join(lone.withColumnRenamed("f", "b"), "b", "left_semi")
    clear = partner.where("n = 1")
    usable_half = clear.select("f").unionByName(lone)
    half_own = own.where("words = ''").select("cid", "f")
    told = alias.join(full_ids, "cid", "left_anti").withColumn("n", node("f")).join(of, "n", "left").select("cid", F.coalesce("group_id", "n").alias("g"))
    told = told.groupBy("cid").agg(F.count_distinct("g").alias("n"), F.min("g").alias("g")).where("n = 1")
    rest = [
        edge(groups, F.col("id"), F.col("group_id")),
        edge(clear, node("f"), F.col("g")),
        edge(both_lone, node("a"), node("b")),
        edge(half_own.join(usable_half, "f", "left_semi"), F.col("cid"), node("f")),
        edge(told, F.col("cid"), F.col("g")),
    ]
    everyone = base.select(F.col("cid").alias("id")).where("id IS NOT NULL").distinct()
    whole = components(everyone, reduce(DataFrame.unionByName, rest))
    return whole.join(everyone, "id", "left_semi").select(F.col("id").alias("cid"), "group_id")


def same_entity_pairs(mentions: DataFrame, linked: DataFrame) -> DataFrame:
    """``a, b``: all pairs of canonical ids of one type that are one person or organisation."""
    g = same_entities(mentions, linked)
    kinds = linked.where(F.col("type").isin(*KINDS)).select(F.col("canonical_id").alias("cid"), "type").distinct()
    g = cut(g.join(kinds, "cid"))
    several = g.groupBy("group_id", "type").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("group_id", "type")
    m = g.join(several, ["group_id", "type"], "left_semi")
    x, y = m.select("group_id", "type", F.col("cid").alias("a")), m.select("group_id", "type", F.col("cid").alias("b"))
    return x.join(y, ["group_id", "type"]).where("a < b").select("a", "b")
