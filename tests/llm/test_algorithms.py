"""Algorithms of the subpackage against brute force on small fixtures."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from seamark.llm import components, name_parts, name_variants, near_duplicates, vector_neighbors


# components
def test_components(spark):
    rng = random.Random(3)
    edges = [(f"v{rng.randrange(400)}", f"v{rng.randrange(400)}") for _ in range(260)] + [("hub", f"h{i}") for i in range(300)] + [(f"p{i}", f"p{i + 1}") for i in range(60)] + [("v1", "v1"), (None, "n1"), ("n2", None)]
    parent: dict[str, str] = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a or b), find(b or a)
        if a and b:
            parent[max(x, y)] = min(x, y)
    e = spark.createDataFrame([*edges, *edges[:50]], "a string, b string")
    v = spark.createDataFrame([("alone",), (None,), ("v1",)], "id string")
    got = {r.id: r.group_id for r in components.components(v, e.where("a IS NOT NULL AND b IS NOT NULL")).collect()}
    want = {k: find(k) for k in parent if not k.startswith("n")} | {"alone": "alone"}
    assert got == want
    assert components.components(v.where("false"), e.where("false")).count() == 0


def test_mention_groups(spark):
    m = spark.createDataFrame([("a", 1), ("b", 1), ("a", 2)], "mention_id string, group_id int")
    x = spark.createDataFrame([("b", "c", None), (None, "z", 0.1)], "mention_a string, mention_b string, score double")
    link = spark.createDataFrame([(["c", None, "d"],), ([],), (None,)], "mention_ids array<string>")
    assert {tuple(r) for r in components.mention_groups(m, x, link).collect()} == {("a", "a"), ("b", "b"), ("c", "b"), ("d", "b"), ("z", "z")}


# near_duplicates
@given(st.lists(st.integers(0, 2**24 - 1), min_size=1, max_size=200))
def test_gray_index_finds_all(codes):
    c = np.array(codes, np.uint32)
    i, j = near_duplicates.GrayIndex(c, leaf=4).pairs(2)
    got = sorted(tuple(sorted(p)) for p in zip(i.tolist(), j.tolist()))
    assert got == [(a, b) for a in range(len(c)) for b in range(a + 1, len(c)) if bin(int(c[a] ^ c[b])).count("1") <= 2]


def test_gray_neighbours():
    r = near_duplicates.gray_rank(np.arange(64, dtype=np.uint32))
    by_rank = np.argsort(r)
    assert all(bin(int(by_rank[k] ^ by_rank[k + 1])).count("1") == 1 for k in range(63))


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(900)]
    rows = []
    for f in range(120):
        base = rng.sample(vocab, 40)
        for k in range(3):
            t = list(base)
            for _ in range(rng.randrange(0, 9)):
                t[rng.randrange(40)] = rng.choice(vocab)
            rng.shuffle(t)
            rows.append((f"e{f:03d}-{k}", " ".join(t)))
    rows += [("x1", rows[0][1]), ("x2", rows[0][1]), ("n", None), ("short", "a b c"), ("e000-0", rows[0][1])]
    sets = {i: set(t.split()) for i, t in rows if t and len(t.split()) >= 20}
    ids = sorted(sets)
    want = {(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.7}
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], "element_id string, text string, words string")
    got = {(r.a, r.b) for r in near_duplicates.near_duplicate_pairs(df, "element_id", "text").collect()}
    assert not got - want and len(got & want) >= 0.98 * len(want)
    assert near_duplicates.near_duplicate_pairs(df.where("false"), "element_id", "text").count() == 0


def test_crowded_parts_and_wide_sections(spark):
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(500)]
    hot = rng.sample(vocab, 40)
    rows = []
    for f in range(150):  # a third of all records are close to one text
        base = list(hot) if f % 3 == 0 else rng.sample(vocab, 40)
        for k in range(2):
            t = list(base)
            for _ in range(rng.randrange(1, 6)):
                t[rng.randrange(40)] = rng.choice(vocab)
            rows.append((f"e{f:03d}-{k}", " ".join(t)))
    sets = {i: set(t.split()) for i, t in rows}
    ids = sorted(sets)
    want = {(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.7}
    classes, members = near_duplicates.classes_of(near_duplicates.word_sets(spark.createDataFrame(rows, "id string, text string"), "id", "text", 20))
    of = {r.c: r.id for r in members.collect()}
    for block, plan in ((8, None), (4096, (33, 32)), (8, (33, 32))):
        pairs = [(of[r.a], of[r.b]) for r in near_duplicates.candidate_pairs(classes, 0.7, block, plan).collect()]
        assert len(pairs) == len(set(pairs))  # each pair once
        assert len(want & {(min(p), max(p)) for p in pairs}) >= 0.98 * len(want)


def test_plan_grows_with_the_records():
    plans = [near_duplicates.plan_of(n, 0.7) for n in (10, 10**6, 10**8, 10**10)]
    assert plans[0] == plans[1] == (16, 24) and plans[2][1] == 32 and plans[3][1] == 40 and plans[3][0] > plans[2][0] > 16


def test_copies_of_a_record_stay_few(spark):
    assert near_duplicates.plan_of(11_000_000, 0.7)[0] <= 20  # each holds a record once; before, 40 held it three times
    # Records more alike get longer keys.
    assert near_duplicates.plan_of(10**6, 0.7, (0.3, 0.1, 0.04, 0.016))[0] > near_duplicates.plan_of(10**6, 0.7)[0]
    rng = random.Random(2)
    vocab, stock = [f"w{i}" for i in range(5000)], [f"s{i}" for i in range(12)]  # words that all records have
    rows = [(f"e{i:04d}", " ".join(rng.sample(vocab, 28) + stock)) for i in range(1500)]
    classes, _ = near_duplicates.classes_of(near_duplicates.word_sets(spark.createDataFrame(rows, "id string, text string"), "id", "text", 20))
    low = near_duplicates.min_hashes(pa.array([" ".join(sorted(t.split())) for _, t in rows[:500]]), 48)
    e = near_duplicates.entries(classes, 16, 24, near_duplicates.dealt(low, 16, 3)).groupBy("key").count().collect()
    assert sum(r["count"] for r in e) == 16 * 1500 and max(r["count"] for r in e) < 500
    worst = near_duplicates.entries(classes, 16, 24, list(range(48))).groupBy("key").count().agg({"count": "max"}).first()[0]
    assert max(r["count"] for r in e) <= worst


def test_groups_against_brute_force():
    rng = np.random.default_rng(6)
    base = rng.integers(1 << 63, size=(40, near_duplicates.BITS // 64), dtype=np.uint64)
    fp = base[rng.integers(40, size=400)] ^ (np.uint64(1) << rng.integers(64, size=(400, base.shape[1]), dtype=np.uint64))
    group = np.sort(np.r_[np.zeros(150), rng.integers(1, 30, size=249), [99]])  # large, small and single
    got = [(min(p), max(p)) for i, j in near_duplicates.near_rows(group, fp, 0.7) for p in zip(i.tolist(), j.tolist())]
    near = lambda a, b, bits: np.bitwise_count(fp[a, : bits // 64] ^ fp[b, : bits // 64]).sum() <= near_duplicates._most(bits, 0.7)
    assert sorted(got) == [(a, b) for a in range(400) for b in range(a + 1, 400) if group[a] == group[b] and all(near(a, b, n) for n in range(64, near_duplicates.BITS + 1, 64))]


def test_words_and_records_of_odd_texts(spark):
    long = " ".join(f"w{i}" for i in range(20))
    rows = [("a", long), ("b", long.upper().replace(" ", "\u00e9,\n")), ("c", long.replace(" ", "\u212a")), ("d", long[:-4]), ("e", ""), ("f", None), (None, long), ("a", long), ("g", long + " K\u0130x 7")]
    sets = near_duplicates.word_sets(spark.createDataFrame(rows, "id string, text string"), "id", "text", 20)
    words = " ".join(sorted(long.split()))
    assert {(r.id, r.words) for r in sets.collect()} == {("a", words), ("b", words), ("c", words), ("g", " ".join(sorted([*long.split(), "k", "x", "7"])))}
    classes, members = near_duplicates.classes_of(sets)
    assert sorted(r.rep for r in classes.collect()) == ["a", "g"] and sorted(r.id for r in members.collect()) == ["a", "b", "c", "g"]


# vector_neighbors
def test_unsettled_graphs_raise_and_hubs_are_met(spark):
    rng = np.random.default_rng(4)
    hub = rng.standard_normal(24)
    v = np.concatenate([hub[None], hub + 0.9 * rng.standard_normal((400, 24))]).astype(np.float32)
    df = spark.createDataFrame([(f"c{i:04d}", "m", 24, x.tolist()) for i, x in enumerate(v)], "chunk_id string, model string, dim int, embedding array<float>")
    nodes, _ = vector_neighbors.classes_of(vector_neighbors.unit_vectors(df))
    even = spark.createDataFrame([(f"c{i:04d}", "m", 24, x.tolist()) for i, x in enumerate(rng.standard_normal((400, 24)))], "chunk_id string, model string, dim int, embedding array<float>")
    with pytest.raises(RuntimeError):
        vector_neighbors.build_graph(vector_neighbors.classes_of(vector_neighbors.unit_vectors(even))[0], tables=2, max_rounds=1, settled=0.0)
    x = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = x @ x.T
    np.fill_diagonal(s, -2)
    rank = {i: set(np.argsort(-s[i])[:5]) for i in range(len(v))}
    at = {r.v: int(np.frombuffer(r.vec, np.float32)[None].dot(x.T).argmax()) for r in nodes.collect()}
    got = {at[r.v]: {at[e.w] for e in r.list[:5]} for r in vector_neighbors.build_graph(nodes, tables=3).collect()}
    assert sum(len(rank[i] & got[i]) for i in rank) >= 0.95 * 5 * len(v)


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((150, 24))
    v = np.concatenate([base + 0.25 * rng.standard_normal(base.shape) for _ in range(4)]).astype(np.float32)
    rows = [(f"c{i:04d}", "m", 24, v[i].tolist()) for i in range(len(v))] + [("d1", "m", 24, v[0].tolist()), ("z", "m", 24, [0.0] * 24), ("q", "m", 24, [float("nan")] * 24), ("s", "m", 24, [1.0]), ("n", "m", 24, None), ("o", "other", 24, v[0].tolist()), ("c0000", "m", 24, v[0].tolist())]
    df = spark.createDataFrame(rows, "chunk_id string, model string, dim int, embedding array<float>")
    ids = [r[0] for r in rows[: len(v)]] + ["d1"]
    x = np.concatenate([v, v[:1]]).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = np.round(x @ x.T, 9)
    want = set()
    for i, a in enumerate(ids):
        order = sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-s[i, j], ids[j]))[:5]
        want |= {(min(a, ids[j]), max(a, ids[j])) for j in order if s[i, j] >= 0.8}
    got = {(r.a, r.b) for r in vector_neighbors.similar_pairs(df).collect()}
    assert len(got & want) >= 0.99 * len(want) and len(got - want) <= 0.01 * len(want)
    q = vector_neighbors.unit_vectors(df).where("id IN ('c0007', 'c0300', 'c0411')")
    found = {(r["query"], r["id"]) for r in vector_neighbors.search(df, q).collect()}
    hits = sum((a, ids[j]) in found for a in ("c0007", "c0300", "c0411") for j in sorted((j for j in range(len(ids)) if ids[j] != a), key=lambda j: (-s[ids.index(a), j], ids[j]))[:5])
    assert hits >= 0.9 * 15
    assert vector_neighbors.similar_pairs(df.where("false")).count() == 0


# name_variants
@given(st.text("abcd", max_size=12), st.lists(st.text("abcd", max_size=12), min_size=1, max_size=8))
def test_bit_vector_distance(pattern, names):
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    x, size = name_variants.letters(names)
    assert name_variants.distances(pattern, x, size).tolist() == [plain(pattern, n) for n in names]
    long = pattern * 7
    assert name_variants.distances(long, x, size).tolist() == [plain(long, n) for n in names]


def test_radius_join_loses_nothing(spark):
    rng = random.Random(2)
    keys = ["".join(rng.choice("bdfgklmnrstv") + rng.choice("aeiou") for _ in range(4)) for _ in range(150)]
    keys += [k[:3] + rng.choice("aeioubd") + k[4:] for k in keys[:80]]
    forms = spark.createDataFrame([(i, "ORGANIZATION", k, "x", "x", "") for i, k in enumerate(keys)], "f bigint, kind string, key string, words string, initials string, extra string")
    got = {tuple(sorted((r.a, r.b))) for r in name_variants.radius_links(forms).collect()}
    x, size = name_variants.letters(keys)
    want = set()
    for i, k in enumerate(keys):
        d = name_variants.distances(k, x, size)
        want |= {(i, int(j)) for j in np.flatnonzero(d <= 2) if i < j and name_parts.osa(k, keys[j], 2) <= 2}
    assert got == want


def test_crowded_cells_lose_nothing(spark):
    rng = random.Random(6)
    keys = ["".join(rng.choice("bdfgklmn") + rng.choice("aeiou") for _ in range(rng.randrange(1, 6))) for _ in range(260)] + ["ß" * 3, "петров", "петрова", "x" * 90, "x" * 91, "li", "lu", "a"]
    keys = sorted({*keys, *(k[:2] + rng.choice("aeioubd") + k[2:] for k in keys[:120]), *(k[1:] for k in keys[:120] if len(k) > 1)})
    df = spark.createDataFrame([(kind, k) for k in keys for kind in ("PERSON", "ORGANIZATION")], "kind string, key string")
    want = set()
    for kind, short in (("PERSON", 3), ("ORGANIZATION", 4)):
        for i, a in enumerate(keys):
            for b in keys[i + 1 :]:
                n = min(len(a), len(b))
                if plain_distance(a, b) <= (0 if n < short else 1 if n <= 6 else 2):
                    want.add((kind, a, b))
    for own, other in ((2048, 65_536), (4, 16)):
        assert {tuple(r) for r in name_variants.key_pairs(df, 2, own, other).collect()} == want


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def linked_pairs(spark, names):
    linked = spark.createDataFrame([(c, "d", t, n, None) for c, t, n in names], "canonical_id string, doc_id string, type string, name string, mention_ids array<string>")
    mentions = spark.createDataFrame([], "mention_id string, type string, label string, aliases array<string>")
    return {(r.a, r.b) for r in name_variants.same_entity_pairs(mentions, linked).collect()}


def test_long_short_and_other_names(spark):
    long = "Acme " + "x" * 250
    names = [("1", "ORGANIZATION", f"{long} Left Works"), ("2", "ORGANIZATION", f"{long} Right Yards"), ("3", "ORGANIZATION", f"{long} Left Works Inc."), ("4", "ORGANIZATION", "IBM Corp."), ("5", "ORGANIZATION", "IBM Corporation"), ("6", "PERSON", "Wei Li"), ("7", "PERSON", "Li, Wei"), ("8", "PERSON", "Иван Петров"), ("9", "PERSON", "Иван   Петров"), ("a", "PERSON", "李伟"), ("b", "PERSON", "李 伟"), ("c", "ORGANIZATION", "3M"), ("d", "ORGANIZATION", "3M Co."), ("e", "ORGANIZATION", "SAP"), ("f", "ORGANIZATION", "SAB")]
    assert linked_pairs(spark, names) == {("1", "3"), ("4", "5"), ("6", "7"), ("8", "9"), ("a", "b"), ("c", "d")}


def test_entities(spark):
    names = [("1", "PERSON", "Nicholas P. Barnilvani"), ("2", "PERSON", "Barnilvani, Nick"), ("3", "PERSON", "N. Barnilvani"), ("4", "PERSON", "Olga Barnilvani"), ("5", "ORGANIZATION", "The Kotenrusvon Composites Kinetics Inc."), ("6", "ORGANIZATION", "Kotenrsuvon Comp. Kin."), ("7", "ORGANIZATION", "Kotenrusvon CK"), ("8", "ORGANIZATION", "Kotenrusvon Defense LLC"), ("9", "FACILITY", "Kotenrusvon CK"), ("10", "PERSON", None), ("11", "PERSON", ""), ("1", "PERSON", "Nicholas P. Barnilvani"), (None, "PERSON", "X Y")]
    linked = spark.createDataFrame([(c, "d", t, n, ["m" + str(c)]) for c, t, n in names], "canonical_id string, doc_id string, type string, name string, mention_ids array<string>")
    mentions = spark.createDataFrame([("m1", "PERSON", "Nicholas P. Barnilvani", None), ("m9", "X", None, [None, "q"])], "mention_id string, type string, label string, aliases array<string>")
    got = {(r.a, r.b) for r in name_variants.same_entity_pairs(mentions, linked).collect()}
    assert got == {("1", "2"), ("1", "3"), ("2", "3"), ("5", "6"), ("5", "7"), ("6", "7")}
    assert name_variants.same_entity_pairs(mentions.where("false"), linked.where("false")).count() == 0
