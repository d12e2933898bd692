"""Core operators on small fixtures with results worked out by hand."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from seamark.functions.text import matches, spans, strip
from seamark.operators import contract, elements, embedding, entities, linking, normalize, promotion, properties
from seamark.plans import reports
from seamark.sources import files

PAGES = "doc_id string, source_path string, pages array<string>, text string"


@pytest.fixture(scope="module")
def docs(spark):
    return normalize.coerce(spark.createDataFrame([("doc-abc", "a.pdf", ["Alpha bravo.\nCharlie delta.", "Echo foxtrot golf."], None), ("doc-abc", "a.pdf", ["Alpha bravo.\nCharlie delta.", "Echo foxtrot golf."], None), ("t", None, None, "One; two."), ("nul", None, [None, ""], None)], PAGES))


def test_sentence_ids_and_offsets(docs):
    got = {(r.page, r.char_start, r.char_end): r.sent_id for r in normalize.sentences(docs).where("doc_id = 'doc-abc'").collect()}
    assert got == {(1, 0, 12): "918e95be3b248583", (1, 13, 27): "bb388652a676f795", (2, 0, 18): "a1ebd2a5e84714c7"}


def test_spans_are_slices(spark):
    texts = ["", "  ", "a", "É 😀.  B?!” c\n\n\nd\r\ne", "x" * 5000 + ". y"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in df.select("t", F.explode(spans(F.col("t"))).alias("s")).collect():
        piece = r.t[r.s.a : r.s.b]
        assert piece and piece == piece.strip()


def test_chunks_pack_and_validate(spark, docs):
    s = normalize.sentences(docs)
    c = normalize.chunks(s)
    one = c.where("doc_id = 'doc-abc'").first()
    assert one.chunk_id == "4bfc5cd02ec1bc10" and (one.page_start, one.page_end, one.n_tokens) == (1, 2, 7)
    small = normalize.chunks(s, 4).where("doc_id = 'doc-abc'").orderBy("ord").collect()
    assert [x.n_tokens for x in small] == [4, 3]
    assert normalize.violations(docs, s, c).count() == 0
    broken = s.withColumn("text", F.concat("text", F.lit("!")))
    assert {r.rule for r in normalize.violations(docs, broken, c).collect()} == {"slice_mismatch"}
    assert normalize.summary(docs, s, c).where("doc_id = 'nul'").first().n_chunks == 0


def test_windows(spark):
    w = normalize.fixed_windows(spark.createDataFrame([("a", "x" * 2100), ("b", ""), ("c", None)], "doc_id string, text string"))
    assert sorted((r.doc_id, r.start, len(r.text)) for r in w.collect()) == [("a", 0, 1200), ("a", 1000, 1100), ("a", 2000, 100)]


def test_entities_and_links(spark):
    t = "ACME visited https://example.com and emailed JOHN@EXAMPLE.COM 😀 Bob"
    e = entities.extract(spark.createDataFrame([("D1", "C1", t)], "doc_id string, chunk_id string, text string"))
    rows = e.collect()
    assert all(t[r.start : r.end] == r.text for r in rows)
    assert sorted((r.type, r.text) for r in rows) == [("EMAIL", "JOHN@EXAMPLE.COM"), ("ORG", "ACME"), ("ORG", "COM"), ("ORG", "EXAMPLE"), ("ORG", "JOHN"), ("PERSON", "Bob"), ("URL", "https://example.com")]
    assert entities.links(e).count() == 1


def mention(i, text, kind, sent=0):
    return ("d", f"m{i}", kind, text, i * 10, i * 10 + len(text), sent, i)


SCHEMA = "doc_id string, mention_id string, type string, text string, start int, end int, sent_no int, n int"


def test_coreference(spark):
    rows = [mention(1, "Jane", "PERSON"), mention(2, "Bob", "PERSON"), mention(3, "She", "PERSON"), mention(4, "him", "PERSON"), mention(5, "ACME", "ORG"), mention(6, "drone", "PRODUCT"), mention(7, "It", "PERSON")]
    m = spark.createDataFrame(rows, SCHEMA)
    got = {r.mention_id: (r.antecedent_mention_id, r.coref_rule) for r in entities.resolve(m).collect()}
    assert got["m3"][0] == "m1" and got["m4"][0] == "m2" and got["m7"] == ("m6", "prefer_device_over_org")


def test_long_chain_is_one(spark):
    m = spark.createDataFrame([mention(1, "Jane", "PERSON"), *[mention(i, "She", "PERSON") for i in range(2, 12)]], SCHEMA)
    c = entities.chains(m, entities.resolve(m)).collect()
    assert len(c) == 11 and {r.chain_id for r in c} == {"m1"}


def test_coreference_query_against_brute_force(spark, tmp_path):
    from seamark.plans import queries

    rng = random.Random(4)
    word = lambda: rng.choice(["It", "She", "Him", "They", "Jane", "Bob", "Drone", "Boats", "ACME"]) if rng.random() < 0.12 else rng.choice(["went", "to", "see", "near", "now"])
    pages = [[" ".join(" ".join([*(word() for _ in range(12)), "then."]) for _ in range(70)) for _ in range(3)] for _ in range(4)]
    # A doc whose only name lies 29 mentions before its pronoun.
    pages.append(["Jane met " + "Boats " * 28 + "and She left."])
    spark.createDataFrame([(f"d{i}", "", p, None) for i, p in enumerate(pages)], PAGES).write.parquet(str(tmp_path / "extracted_docs.parquet"))
    q = queries.queries()
    place = {r.chunk_id: r.ord for r in q["token_chunks"](spark, str(tmp_path)).collect()}
    by_doc = {}
    for r in sorted(q["entity_offsets"](spark, str(tmp_path)).collect(), key=lambda r: (place[r.chunk_id], r.start, r.end, r.type)):
        by_doc.setdefault(r.doc_id, []).append(r)
    # Per pronoun: plural or not, genders that fit, whether devices come first.
    forms = {"it": (False, None, True), "she": (False, "fem", False), "him": (False, "masc", False), "they": (True, None, False)}
    gender = {"jane": "fem", "she": "fem", "bob": "masc", "him": "masc", "it": "neut"}
    want = {}
    for rows in by_doc.values():
        for i, r in enumerate(rows):
            if r.text.lower() not in forms:
                continue
            plural, who, device = forms[r.text.lower()]
            fits = [c for c in reversed(rows[max(0, i - 30) : i]) if (c.text in ("They", "Boats")) == plural and (who is None or gender.get(c.text.lower(), "unknown") in (who, "unknown"))]
            best = next((c for c in fits if device and c.text == "Drone"), fits[0] if fits else None)
            key = lambda c: f"{c.doc_id}:{c.chunk_id}:{c.start}-{c.end}:{c.type}"
            want[key(r)] = best and key(best)
    got = {r.mention_id: r.antecedent_mention_id for r in q["coreference"](spark, str(tmp_path)).collect()}
    assert max(place.values()) >= 2 and got == want


def test_dates_and_types(spark, docs):
    d = spark.createDataFrame([("x", ["Made 2024-05-06, on March 3, 2021 and in 1999."]), ("y", ["Not 2024-13-45 but Mayor 1, 2020"]), ("z", None)], "doc_id string, pages array<string>")
    got = [(r.doc_id, r.value, r.grain) for r in properties.fallback_dates(d).orderBy("doc_id", "ord").collect()]
    assert got == [("x", v, g) for v, g in (("2024-05-06", "day"), ("March 3, 2021", "day"), ("2024", "year"), ("2021", "year"), ("1999", "year"))] + [("y", "Mayor 1, 2020", "day"), ("y", "2024", "year"), ("y", "2020", "year")]
    assert properties.fallback_dates(d, dated=d.where("doc_id = 'x'")).where("doc_id = 'x'").count() == 0
    paths = ["a/b.PDF", "x.pptx", "x.ppt", "x.docx", "n.txt", "n.md", "", None]
    t = spark.createDataFrame([(str(i), p) for i, p in enumerate(paths)], "doc_id string, source_path string")
    assert [r.doc_type for r in properties.doc_types(t).orderBy("doc_id").collect()] == ["pdf", "presentation", "presentation", "document", "text", None, None, None]
    assert properties.doc_types(t.withColumn("mime", F.lit("text/plain"))).where("doc_type <> 'text'").count() == 0


def test_normal_names(spark):
    names = {"The Batteries": "battery", "an Apple": "apple", "buses": "bus", "glass": "glass", "boats": "boat", "ies": "ie", "ses": "se", "s": "", None: ""}
    df = spark.createDataFrame([(k,) for k in names], "t string").select("t", properties.normal_name(F.col("t")).alias("n"))
    assert {r.t: r.n for r in df.collect()} == names


def test_properties_of_documents(spark):
    rows = [("d", "m1", "PERSON", "Jane", 1, "e1"), ("d", "m2", "PERSON", "J. Doe", 2, "e1"), ("d", "m3", "PERSON", "Bob", 3, None), ("d", "m4", "LOCATION", "Austin", 4, None), ("d", "m5", "DEVICE", "boat", 5, None), ("d", "m6", "VEHICLE", "the Boats", 6, None), ("d", "m7", "OTHER", "thing", 7, None), ("d", "m8", None, None, 8, None), ("x", "m9", "DATE", "May 5", 1, None)]
    m = spark.createDataFrame(rows, "doc_id string, mention_id string, type string, text string, n int, entity_id string")
    known = spark.createDataFrame([("d", "in/report.pdf", ["Preview 2024"]), ("only", "", ["2020-01-02"])], "doc_id string, source_path string, pages array<string>")
    got = {r.doc_id: r for r in properties.document_properties(m, known).collect()}
    d = got["d"]
    assert [(p.name, p["count"], p.mention_ids) for p in d.who.people] == [("Jane", 2, ["m1", "m2"]), ("Bob", 1, ["m3"])]
    assert [(t.name, t["class"], t["count"]) for t in d.how.things] == [("boat", "DEVICE", 2)]
    assert d.what.doc_type == "pdf" and [w.value for w in d.when] == ["2024"] and [w.value for w in d["where"]] == ["Austin"]
    assert (d.stats.persons, d.stats.dates, d.stats.mentions_total) == (2, 1, 8)
    assert [(w.value, w.grain) for w in got["x"].when] == [("May 5", "unknown")] and got["x"].what.filename is None
    assert {r["key"] for r in properties.groups(m, 2).where("bucket = 'things'").collect()} == {"boat"}
    assert {r["key"] for r in properties.groups(m, other_things=True).where("bucket = 'things'").collect()} == {"boat", "thing"}
    stats = {r.doc_id: (r.persons, r.dates, r.mentions_total) for r in properties.statistics(m, known).collect()}
    assert stats == {"d": (2, 1, 8), "x": (0, 1, 1), "only": (0, 2, 0)}
    assert [tuple(r) for r in properties.top_names(properties.groups(m), "people").collect()] == [("Jane", 2), ("Bob", 1)]
    assert properties.document_properties(m.where("false"), known.where("false")).count() == 0


def test_canonical_ids(spark):
    one = spark.range(1).select(linking.canonical_id(F.lit("IBM"), F.lit("ibm")).alias("u")).first().u
    assert one == "49bd4d52-7917-582f-9d6a-eb0ec1f93cfd"
    m = spark.createDataFrame([("1", "ORG", " IBM ", "d"), ("2", "ORG", "ibm", "d"), ("3", "ORG", "ibm", "d"), ("4", None, None, "d"), ("4", None, None, "d")], "mention_id string, type string, label string, doc_id string")
    g = linking.groups(m)
    got = {r.normalized_label: (r.name, r.mention_ids) for r in g.collect()}
    assert got["ibm"] == ("ibm", ["1", "2", "3"]) and got[""] == ("", ["4"])
    known = spark.createDataFrame([("old", "ORG", "ibm", "IBM")], "canonical_id string, type string, normalized_label string, primary_name string")
    assert {r.canonical_id for r in linking.register(g, known).where("type = 'ORG'").collect()} == {"old"}
    cache = spark.createDataFrame([("organization|IBM", "Q1")], "key string, id string")
    assert {(r.type, r.external_id) for r in linking.external_ids(g, cache, "w", ("ORG",)).collect()} == {("ORG", "Q1"), ("UNKNOWN", None)}


def test_registry_tables(spark):
    rows = [("d", "c1", "ORG", "acme", "ACME", ["m1"]), ("d", "c2", "ORG", "acme inc", "Acme", ["m2"]), ("e", "c1", "ORG", "acme", "Acme", ["m3"])]
    g = spark.createDataFrame(rows, "doc_id string, canonical_id string, type string, normalized_label string, name string, mention_ids array<string>")
    known = spark.createDataFrame([("c1", "ACME")], "canonical_id string, alias string")
    assert {tuple(r) for r in linking.register_aliases(g, known).collect()} == {("c1", "ACME"), ("c1", "Acme"), ("c2", "Acme")}
    cache = spark.createDataFrame([("organization|acme", "Q1", 0), (" ACME ", "Q123", 1)], "key string, id string, pos int")
    found = linking.external_ids(g, cache, "wikidata")
    assert {r.external_id for r in found.collect()} == {"Q123"}  # of equal keys the later one
    ids = linking.register_external_ids(found.select("canonical_id", "source", "external_id"))
    assert [tuple(r) for r in ids.collect()] == [("c1", "wikidata", "Q123")]  # one owner
    assert linking.register_external_ids(found, spark.createDataFrame([("c0", "wikidata", "Q123")], "canonical_id string, source string, external_id string")).first().canonical_id == "c0"
    written = linking.linked_rows(g, [found]).collect()
    assert len(written) == 3 and all(r.external_ids[0].id == "Q123" for r in written)
    assert linking.linked_rows(g, []).first().external_ids == []


def test_embedding_models(spark):
    class Tiny:
        name, dim = "tiny", 2

        def embed(self, texts):
            assert len(texts) <= 2
            return [[float(len(t)), 1.0] for t in texts]

    def broken():
        raise ValueError("no model")

    c = spark.createDataFrame([("d", str(i), "x" * i) for i in range(5)] + [("d", "n", None)], "doc_id string, chunk_id string, text string")
    got = {r.chunk_id: r.embedding for r in embedding.embed(c, Tiny, 2, "tiny", batch=2).collect()}
    assert got == {str(i): [float(i), 1.0] for i in range(5)}
    assert embedding.embed(c, broken, 4, fall_back=True).count() == 5
    with pytest.raises(Exception, match="no model"):
        embedding.embed(c, broken, 4).collect()
    sizes = {"modelA.gguf": 300, "bge-small.gguf": 100, "nomic-large.gguf": 200, "embed.bin": 1}
    assert embedding.pick_model(sizes) == "bge-small.gguf" and embedding.pick_model({"b.gguf": 2, "a.gguf": 2}) == "a.gguf" and embedding.pick_model({}) is None
    assert embedding.health(embedding.LocalModel) == {"ok": True, "error": None, "model": "local-deterministic", "dim": 64} and not embedding.health(broken)["ok"]
    cut = embedding.embed(c, max_tokens=1).select("truncated").distinct().collect()
    assert [r.truncated for r in cut] == [False]


def test_embedding_is_deterministic(spark):
    c = spark.createDataFrame([("d", "c", "hello world"), ("d", "n", None)], "doc_id string, chunk_id string, text string")
    e = linking.embed_local(c, dim=4).collect()
    rng = random.Random(int(hashlib.sha1(b"local-deterministic|4|hello world").hexdigest()[:16], 16))
    assert [r.embedding for r in e] == [[rng.uniform(-1, 1) for _ in range(4)]]
    done = linking.embed_local(c, dim=4).select("chunk_id", "model", "text_sha1")
    assert linking.embed_local(c, dim=4, done=done).count() == 0


def test_promotion_gates(spark):
    rel = [("s", "USES", "o", "d1", "s1", "m1", 0.7), ("s", "USES", "o", "d1", "s2", "m2", 0.7), ("s", "USES", "o", "d2", "s3", "m3", 0.7), ("s", "BOGUS", "o", "d", "s1", "m4", 0.6), ("s", "STARTS_AT_TRL", "t", "d", "s1", "m5", 0.9), ("s", "STARTS_AT_TRL", "t", "d", "s2", "m6", 0.9), ("s", "USES", None, "d", "s", "m7", 1.0)]
    m = spark.createDataFrame(rel, "subj string, predicate string, obj string, doc_id string, sent_id string, mention_id string, confidence double")
    can = spark.createDataFrame([("s", "kb_System", ["System"], {"name": "S"}), ("o", "dbo_Technology", ["Technology"], {"uri": "u"}), ("t", "kb_TRL", ["TRL"], {"value": "11"})], "canonical_id string, type string, labels array<string>, key map<string,string>")
    g = promotion.gate(promotion.evidence(m), can, promotion.rules(spark))
    reasons = {r.predicate: r.reasons for r in g.collect()}
    assert reasons["USES"] == [] and reasons["BOGUS"] == ["below_threshold", "predicate_not_allowed"]
    assert reasons["STARTS_AT_TRL"] == ["predicate_constraint_failed", "type_constraint_failed"]
    assert promotion.facts(g).count() == 1 and promotion.quarantine(g).count() == 2
    assert promotion.preflight(promotion.evidence(m), can, promotion.rules(spark)).first().blockers == 2
    assert {(r.name, r.n) for r in promotion.quarantine_summary(promotion.quarantine(g)).where("kind = 'predicate'").collect()} == {("BOGUS", 1), ("STARTS_AT_TRL", 1)}


def test_entity_gates(spark):
    can = spark.createDataFrame([("ok", "kb_System", ["System", "Asset"], {"name": "S"}), ("p", "kb_Person", ["Person"], {"name": "P"}), ("e", "kb_Tool", ["Tool"], {"name": ""}), ("t", "kb_TRL", ["TRL"], {"value": "11"}), ("u", None, [None], {"name": "U"}), ("k", "kb_Tool", ["Tool"], None)], "canonical_id string, type string, labels array<string>, key map<string,string>")
    rows = spark.createDataFrame([("ok", "e")], "subj string, obj string")
    own = spark.createDataFrame([(i, 2) for i in ("ok", "p", "t", "u", "k", "lost")] + [("few", 1)], "canonical_id string, ev_count int")
    g = promotion.gate_entities(promotion.entity_candidates(rows, own), can, promotion.rules(spark))
    assert {r.canonical_id for r in promotion.promoted_entities(g).collect()} == {"ok"}
    q = promotion.quarantined_entities(g)
    assert {r.canonical_id: r.reasons for r in q.collect()} == {
        "p": ["missing_entity_keys", "missing_keys:email"],
        "e": ["missing_keys:name"],
        "t": ["type_constraint_failed"],
        "u": ["missing_entity_keys", "type_constraint_failed"],
        "k": ["missing_entity_keys", "missing_keys:name"],
        "lost": ["missing_object"],
    }
    none = spark.createDataFrame([], "predicate string, reasons array<string>")
    got = {(r.kind, r.name): r.n for r in promotion.quarantine_summary(none, q).collect()}
    assert got["entity_reason", "missing_entity_keys"] == 3 and got["entity_reason", "missing_object"] == 1 and got["entity_type", "kb_Tool"] == 2


CONTRACT = {
    "schema_version": "9",
    "promotion_defaults": {"conf_thr": 0.5, "min_evidence": 1},
    "entities": {"A": {"labels": ["Alpha"], "key": ["id"], "required": ["id", "color"]}, "L": {"labels": ["TRL"], "key": ["value"], "constraints": {"value_range": [1, 9]}}},
    "relations": {"R": {"domain": ["Alpha"], "range": ["TRL"]}, "ANY": {}, "STARTS_AT_TRL": {"range": ["TRL"]}, "M": {"domain": ["Alpha", "Missing"]}},
}
MENTIONS = "subj string, predicate string, obj string, doc_id string, sent_id string, mention_id string, confidence double, props map<string,string>"


def test_contract_from_a_file(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps(CONTRACT))
    c = files.contract(str(tmp_path / "c.json"))
    rel, ent = contract.rules(spark, c)
    assert {r.predicate: (r.domain, r.range) for r in rel.collect()} == {"R": (["Alpha"], ["TRL"]), "STARTS_AT_TRL": (["*"], ["TRL"]), "M": (["Alpha", "Missing"], ["*"])}
    assert contract.thresholds(c) == (0.5, 1) and contract.thresholds(c, 0.9, 3) == (0.9, 3) and contract.lint(c) == ["Missing"]
    can = spark.createDataFrame([("a", "A", ["Alpha"], {"id": "1"}, {"color": "red"}), ("b", "A", ["Alpha"], {"id": "2"}, None), ("t", "L", ["TRL"], {"value": "8"}, None), ("u", "L", ["TRL"], {"value": "x"}, None)], "canonical_id string, type string, labels array<string>, key map<string,string>, props map<string,string>")
    rows = [("a", "R", "t", "d", "s1", "m2", 0.5, None), ("a", "R", "t", "d", "s1", "m1", 0.5, {"w": "1"}), ("a", "R", "u", "d", "s", "m3", 0.9, None), ("t", "R", "a", "d", "s", "m4", 0.9, None), ("a", "STARTS_AT_TRL", "u", "d", "s", "m5", 0.9, None), ("b", "M", "t", "d", None, "m6", 0.9, None)]
    m = spark.createDataFrame(rows, MENTIONS)
    g = promotion.gate(promotion.evidence(m), can, (rel, ent), 0.5, 1)
    got = {(r.subj, r.predicate, r.obj): r.reasons for r in g.collect()}
    assert got == {("a", "R", "t"): [], ("a", "R", "u"): ["type_constraint_failed"], ("t", "R", "a"): ["domain_range_mismatch"], ("a", "STARTS_AT_TRL", "u"): ["predicate_constraint_failed", "type_constraint_failed"], ("b", "M", "t"): ["below_threshold"]}
    f = promotion.fact_rows(g, 0.5, 1, "9").collect()
    assert len(f) == 1 and f[0].props == {"w": "1"} and f[0].subj.labels == ["Alpha"] and f[0].policy.min_ev == 1 and [x.mention_id for x in f[0].evidence.mentions] == ["m1", "m2"]
    proof = promotion.entity_evidence(spark.createDataFrame([("a", "d", "s"), ("a", "d", "s2"), ("b", "d", None), (None, "d", "s"), ("b", "d", "s1")], "canonical_id string, doc_id string, sent_id string"))
    assert {r.canonical_id: (r.ev_count, r.doc_count, r.mention_count) for r in proof.collect()} == {"a": (2, 1, 2), "b": (1, 1, 2)}
    ge = promotion.gate_entities(promotion.entity_candidates(promotion.facts(g), proof, 1), can, (rel, ent))
    assert {r.canonical_id: r.reasons for r in ge.collect()} == {"a": [], "t": [], "b": ["missing_entity_keys"]}
    e = {r.canonical_id: r for r in promotion.entity_rows(ge, proof, "9").collect()}
    assert e["a"].props == {"color": "red"} and e["a"].provenance.ev_count == 2 and e["t"].provenance.ev_count == 0 and e["t"].props == {}


def test_first_mentions_and_last_rows(spark):
    rows = [("s", "USES", "o", f"d{i % 3}", f"s{i:03d}", f"m{i:03d}", None, {"at": str(i)} if i in (40, 41) else {}) for i in range(60)]
    m = spark.createDataFrame([(*r, 100 - i) for i, r in enumerate(rows)], MENTIONS + ", seq int")
    e = promotion.evidence(m).first()
    assert len(e.mentions) == 20 and [x.mention_id for x in e.mentions[:2]] == ["m000", "m003"] and e.ev_count == 60 and e.doc_count == 3 and float(e.avg_confidence) == 0.0
    assert json.loads(e.props) == {"at": "41"}  # the first in the order of the file
    last = promotion.last_rows(spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 3, "z"), ("", 3, "z")], "canonical_id string, seq int, v string"), "canonical_id", "seq")
    assert [tuple(r) for r in last.collect()] == [("a", 2, "y")]
    assert promotion.evidence(m.where("false")).count() == 0


def test_summary_and_preflight_report(spark):
    q = spark.createDataFrame([("s" * 80, "P", "o", ["a", "b"]), ("s", "P", "o2", ["a"])], "subj string, predicate string, obj string, reasons array<string>")
    ents = spark.createDataFrame([(f"e{i}", None, ["missing_keys:uri,name"]) for i in range(7)], "canonical_id string, type string, reasons array<string>")
    got = {(r.kind, r.name): (r.n, r.examples) for r in promotion.quarantine_summary(q, ents).collect()}
    assert got["missing_key", "uri"] == (7, [f"entity:e{i}" for i in range(5)]) and got["total", "entities"] == (7, None) and got["reason", "a"][0] == 2
    assert got["entity_type", None][0] == 7 and got["reason", "b"][1] == ["rel:" + "s" * 59 + "…"]
    text = reports.markdown("T", promotion.quarantine_summary(q, ents), {"reason": "Reasons", "x": "Nothing"})
    assert "- `a`: 2 (such as rel:" in text and text.rstrip().endswith("- none")
    rules = contract.rules(spark, CONTRACT)
    can = spark.createDataFrame([("a", "A", ["Alpha"], {"id": ""}), ("t", "L", ["TRL"], {"value": "11"})], "canonical_id string, type string, labels array<string>, key map<string,string>")
    em = spark.createDataFrame([("A", "a"), ("Z", "a"), (None, None), ("L", "t")], "type string, canonical_id string")
    rows = [("a", "R", "t", "d", "s1", "m1", 0.9, None), ("t", "R", "a", "d", "s1", "m2", 0.9, None), ("a", "Q", "t", "d", "s1", "m3", 0.9, None), ("a", "R", "gone", "d", "s1", "m4", 0.9, None)]
    r = {(x.kind, x.name): x.n for x in promotion.preflight_report(em, spark.createDataFrame(rows, MENTIONS), can, rules, 0.7, 2).collect()}
    assert r == {("unknown_type", "Z"): 1, ("unknown_type", "?"): 1, ("out_of_range", "TRL"): 1, ("relation_groups", "all"): 4, ("canon_entities", "all"): 2, ("unknown_predicate", "Q"): 1, ("domain_range", "R"): 1, ("missing_key", "A:id"): 1, ("below_threshold", "groups"): 1}


def test_sections_keep_their_limit(spark):
    rows = [("f", 1, i, k, t) for i, (k, t) in enumerate([("Title", "T1"), ("Text", "a" * 499), ("Text", "b" * 1500), ("Title", "T2"), ("Text", "c" * 10), ("Title", "T3"), ("Text", "d" * 3001), ("Text", None), ("Text", "  ")])]
    e = spark.createDataFrame([(f"e{i}", f, i, k, t, (p,)) for f, p, i, k, t in rows], "element_id string, filename string, ord int, type string, text string, metadata struct<page_number:int>")
    got = [r.text for r in elements.title_sections(e).orderBy("chunk").collect()]
    assert [len(t) for t in got] == [502, 1500, 16, 1500, 1500, 1] and got[2] == "T2\n" + "c" * 10 + "\nT3"
    assert elements.title_sections(e.where("false")).count() == 0
    assets = spark.createDataFrame([("f", "x/b_pg3_1.csv", "table", "q,r"), ("f", "x/a.png", "image", None), ("f", "x/z.csv", "table", None)], "doc_id string, path string, type string, content string")
    rows = [(r.chunk_id, r.text, r.metadata.page_number) for r in elements.with_assets(elements.title_sections(e), assets).orderBy("chunk_id").collect()]
    assert rows[6:] == [(6, "Table Data:\nq,r", 3), (7, "[TABLE: z.csv]", None), (8, "[IMAGE: a.png]", None)]


def test_figures(spark):
    box = "struct<sha1:string,page:int,bbox:array<double>,saved_path:string,ocr_text:string>"
    images = [(None, 1, [100.0, 300.0, 180.0, 480.0], None, None), (None, 1, [220.0, 300.0, 300.0, 480.0], None, None), (None, 1, [500.0, 700.0, 510.0, 710.0], None, None), (None, 2, [0.0], None, None), (None, 2, None, None, None)]
    d = spark.createDataFrame([("d", images), ("e", None)], f"doc_id string, images array<{box}>")
    texts = spark.createDataFrame([("d", 1, 150.0, 160.0), ("d", 1, 10.0, 20.0), ("d", 1, 250.0, 310.0), ("d", 2, 1.0, 2.0)], "doc_id string, page int, y0 double, y1 double")
    assert [tuple(r) for r in elements.figures(d).collect()] == [("d", 1, 80.0, 280.0, 320.0, 500.0)]
    assert [tuple(r) for r in elements.figures(d, texts).collect()] == [("d", 1, 80.0, 130.0, 320.0, 500.0)]


def test_scan_text_and_lemmas(spark):
    cases = {"ﬁne １２\r\nwell-  \n known": "fine 12 wellknown", "a\r\rb  c": "a\n\nb c", " \u00a0x\n\n\ny ": "x\n\ny", "": "", None: None}
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert {r.t: r.x for r in df.select("t", elements.clean_scan_text(F.col("t")).alias("x")).collect()} == cases

    class Token:
        is_space = False

        def __init__(self, text):
            self.text, self.lemma_, self.is_punct, self.is_stop = text, text.rstrip("s"), text == ".", text in ("the", "The")

    class Span:
        label_, start, end, start_char, end_char, text = "ORG", 1, 2, 4, 8, "NASA"

    class Doc(list):
        ents = [Span()]

    nlp = lambda: lambda t: Doc(Token(x) for x in t.split())
    rows = spark.createDataFrame([("The NASA ships .", 7)], "text string, k int")
    r = elements.lemmas(rows, nlp).first()
    assert r.processed_text == "nasa ship" and r.entities[0].text == "NASA" and r.k == 7
    assert elements.lemmas(rows, nlp, stop_words=True, keep_case=True).first().processed_text == "the NASA ship"


def test_boxes_signals_and_text(spark):
    b = spark.createDataFrame([("d", 1, 0.0, 0.0, 10.0, 10.0), ("d", 1, 40.0, 0.0, 60.0, 10.0), ("d", 1, 400.0, 400.0, 410.0, 410.0), ("e", None, 0.0, 0.0, 1.0, 1.0)], "doc_id string, page int, x0 double, y0 double, x1 double, y1 double")
    assert sorted((r.x0, r.x1) for r in elements.merge_boxes(b).collect()) == [(0.0, 60.0), (400.0, 410.0)]
    t = spark.createDataFrame([("well-\nknown  word\n\nnext",)], "t string").select(elements.clean_scan_text(F.col("t")).alias("x")).first().x
    assert t == "wellknown word\n\nnext"
    s = spark.createDataFrame([("d", ["Budget and funding", None], None)], "doc_id string, pages array<string>, text string")
    assert [(r.is_scan, r.is_financial) for r in elements.signals(s).orderBy("page").collect()] == [(True, True), (True, False)]
    assert spark.range(1).select(elements.asset_page(F.lit("table_pg12_3.csv")).alias("p")).first().p == 12


def test_sources(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"doc_id": "d1", "pages": ["x"]}, {"doc_id": "d2", "path": "p/q.txt", "text": "y"}]))
    (tmp_path / "b.json").write_text(json.dumps({"doc_id": "d3", "pages": [None]}))
    got = {(r.doc_id, r.item, r.source_path) for r in files.extracted_json(spark, str(tmp_path)).collect()}
    assert got == {("d1", 1, ""), ("d2", 2, "p/q.txt"), ("d3", 1, "")}
    (tmp_path / "cache.txt").write_text(json.dumps({"organization|ibm": [{"id": ""}, {"id": "Q3"}], "x": "U1"}))
    assert {(r.key, r.id) for r in files.id_cache(spark, str(tmp_path / "cache.txt")).collect()} == {("organization|ibm", "Q3"), ("x", "U1")}
    name = spark.range(1).select(files.safe_name(F.lit("a/b c!.pdf"), F.lit(2)).alias("n"), files.html_text(F.lit("<p>a&amp;b</p><script>x</script>")).alias("h")).first()
    assert name.n == "bc.2" and name.h.split() == ["a&b"]
    files.write_json_lines(spark.createDataFrame([("b",), ("a",)], "v string"), str(tmp_path / "out"))
    assert [r.v for r in files.json_lines(spark, str(tmp_path / "out"), "v string").orderBy("v").collect()] == ["a", "b"]


def test_more_sources(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, body in (("p.html", "<p>Hi</p>"), ("q.MD", "# T"), ("r.md", "# R"), ("s.pdf", "%PDF"), ("t.docx", "zip")):
        (tmp_path / "in" / name).write_text(body)

    def pdf(content):
        return ["page one", content.decode()]

    def docx(content):
        raise ValueError("not a document")

    got = {r.source_path.rsplit("/", 1)[1]: (r.pages, (r.text or "").strip(), r.error) for r in files.extract_pages(files.raw_files(spark, str(tmp_path / "in")), {"pdf": pdf, "docx": docx}).collect()}
    assert got == {"p.html": (None, "Hi", None), "r.md": (None, "# R", None), "s.pdf": (["page one", "%PDF"], "", None), "t.docx": (None, "", "not a document")}
    assert files.extract_pages(files.raw_files(spark, str(tmp_path / "in"))).where("source_path LIKE '%.pdf'").first().pages is None
    (tmp_path / "ent").mkdir()
    (tmp_path / "ent" / "a.b.entities.jsonl").write_text('{"id": "1"}\n\n{"id": "2"}\n')
    (tmp_path / "ent" / "a.rels.jsonl").write_text('{"id": "3"}\n')
    assert {(r.id, r.doc_base) for r in files.entity_lines(spark, str(tmp_path / "ent"), "id string").collect() if r.id} == {("1", "a.b"), ("2", "a.b")}
    (tmp_path / "js").mkdir()
    (tmp_path / "js" / "x.json").write_text(json.dumps({"text": "abc", "n": 1, "list": ["u", {"Body": "v" * 9}, "", 3, 4, "sixth"]}))
    assert {(r.at, r.n) for r in files.text_paths(spark, str(tmp_path / "js")).collect()} == {("$.text", 3), ("$.list[0]", 1), ("$.list[1].Body", 9)}
    one = spark.range(1).select(files.clean_name(F.lit('a<b>:"/\\|?*c')).alias("n"), files.python_json(F.struct(F.lit("é").alias("b"), F.lit(None).cast("int").alias("a"))).alias("j")).first()
    assert one.n == "a_b________c" and one.j == '{"a": null, "b": "é"}'


def test_order_of_written_lines(spark, tmp_path):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("c", 0)], "v string, ord int").repartition(3)
    files.write_json_lines(df, str(tmp_path / "sorted"), spaced=True)
    assert list(files.lines_text(spark, str(tmp_path / "sorted"))) == ['{"ord": 0, "v": "c"}', '{"ord": 1, "v": "b"}', '{"ord": 2, "v": "a"}']
    files.write_json_lines(df, str(tmp_path / "placed"), by="ord")
    assert list(files.lines_text(spark, str(tmp_path / "placed"))) == ['{"v":"c"}', '{"v":"b"}', '{"v":"a"}']


def test_late_documents(spark, tmp_path):
    import datetime

    from seamark.streaming.documents import arrivals

    day = datetime.datetime(2024, 1, 1, 5)
    spark.createDataFrame([(day, "s"), (day, "s"), (day + datetime.timedelta(days=1), "t"), (None, "t")], "published_at timestamp, source string").write.parquet(str(tmp_path / "in"))
    rows = spark.readStream.schema("published_at timestamp, source string").parquet(str(tmp_path / "in"))
    q = arrivals(rows).writeStream.format("memory").queryName("arrived").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination(60)
    assert sorted((r.day.day, r.source, r.n) for r in spark.table("arrived").collect()) == [(1, "s", 2), (2, "t", 1)]


def test_normalized_form(spark, docs):
    s = normalize.sentences(docs)
    n = normalize.normalized(docs, s, normalize.chunks(s))
    r = n.where("doc_id = 'doc-abc'").first()
    assert r.meta.doc_sha1 == "ecb81af1fb1a6117c46216ac54fda7afc68155c9" and r.meta.n_sentences == 3 and [x.sent_id for x in r.sentences] == ["918e95be3b248583", "bb388652a676f795", "a1ebd2a5e84714c7"] and r.chunks[0].page_end == 2
    texts = n.select(F.col("doc_id").alias("name"), F.to_json(F.struct("meta", "doc", "sentences", "chunks", "images")).alias("value"))
    assert normalize.schema_violations(texts).count() == 0
    bad = spark.createDataFrame([("a", '{"meta": {}, "doc": {"doc_id": "x", "pages": 3}, "sentences": {}, "images": []}'), ("b", "{ not: json"), ("c", "[]")], "name string, value string")
    got = {}
    for r in normalize.schema_violations(bad).collect():
        got.setdefault(r.name, set()).add(r.rule)
    assert got == {"a": {"missing key: chunks", "doc missing: source_path", "doc missing: num_pages", "doc.pages must be an array", "sentences must be an array"}, "b": {"unreadable"}, "c": {"unreadable"}}


def test_embedded_chunks(spark):
    chunks = spark.createDataFrame([("d1", "c", "old"), ("d2", "c", "new"), ("d", None, "x"), ("d", "z", None)], "doc_id string, chunk_id string, text string")
    rows = spark.createDataFrame([("c",), ("c",), ("gone",), (None,), ("z",)], "chunk_id string")
    assert sorted(tuple(r) for r in entities.embedded_chunks(rows, chunks).collect()) == [("d", "z", ""), ("d2", "c", "new"), ("d2", "c", "new")]


def test_folder_for_tables(spark):
    from seamark.functions import dist

    t = dist.cut(spark.range(5))
    path = t._table_path
    assert t.count() == 5 and spark.conf.get("spark.checkpoint.dir") in path
    dist.discard(t)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    left = spark.createDataFrame([("hot",)] * 50 + [("a",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([("hot", 1), ("a", 2)], "k string, v int")
    assert sorted((r.v for r in dist.lookup_join(left, right, "k", 4).collect())) == [1] * 50 + [2]
    outer = [(r.k, r.v) for r in dist.lookup_join(left, right, "k", 4, "left").collect()]
    assert len(outer) == 53 and outer.count((None, None)) == 1 and outer.count(("b", None)) == 1 and outer.count(("hot", 1)) == 50


def test_stream(spark, tmp_path):
    from seamark.streaming.documents import document_stream, sentence_stream

    spark.createDataFrame([("d", "One. Two."), ("e", None)], "doc_id string, text string").write.parquet(str(tmp_path / "in"))
    q = sentence_stream(document_stream(spark, str(tmp_path / "in"), "doc_id string, text string")).writeStream.format("memory").queryName("sents").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination(60)
    assert sorted(r.sentence for r in spark.table("sents").collect()) == ["One.", "Two."]


def test_empty_and_strip(spark):
    e = spark.createDataFrame([], PAGES)
    s = normalize.sentences(normalize.coerce(e))
    assert s.count() == 0 and normalize.chunks(s).count() == 0
    assert spark.createDataFrame([(" \x1c a ",)], "t string").select(strip(F.col("t")).alias("x")).first().x == "a"
    assert spark.createDataFrame([("none",)], "t string").select(matches(F.col("t"), "[0-9]").alias("m")).first().m == []
