"""The stages from the command line, one after the other, and their exit codes."""

import hashlib
import json

import pytest

from seamark.__main__ import main


def lines(path):
    return [json.loads(x) for x in path.read_text(encoding="utf-8").splitlines()]


def write_lines(path, rows):
    path.write_text("".join(json.dumps(r) + "\n" for r in rows), encoding="utf-8")
    return str(path)


@pytest.fixture
def at(spark, tmp_path):
    return lambda *names: str(tmp_path.joinpath(*names))


def test_stages(at, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps([{"doc_id": "d1", "path": "x/report.pdf", "pages": ["Jane met ACME. She left. Made 2024.", None]}, {"doc_id": "d2", "file": "b.txt", "text": "Bob. The end"}]))
    assert main(["normalize", at("in"), "--out", at("norm")]) == 0
    assert sorted(p.name for p in (tmp_path / "norm").iterdir()) == ["b.2.normalized.json", "report.normalized.json"]
    doc = json.loads((tmp_path / "norm" / "report.normalized.json").read_text())
    assert doc["doc"]["pages"] == ["Jane met ACME. She left. Made 2024.", ""] and doc["meta"]["n_sentences"] == 3
    assert main(["validate", at("norm")]) == 0
    assert main(["embed", at("norm"), "--out", at("emb"), "--dim", "4"]) == 0
    first = lines(tmp_path / "emb" / "chunks.embedded.jsonl")
    assert len(first) == 2 and len(first[0]["embedding"]) == 4
    assert main(["embed", at("norm"), "--out", at("emb"), "--dim", "4"]) == 0 and lines(tmp_path / "emb" / "chunks.embedded.jsonl") == first
    assert main(["index", at("emb"), "--out", at("index")]) == 0
    assert main(["er", at("emb"), "--normalized", at("norm"), "--out", at("er")]) == 0
    assert {(r["type"], r["text"]) for r in lines(tmp_path / "er" / "all.entities.jsonl")} == {("PERSON", "Jane"), ("ORG", "ACME"), ("PERSON", "She"), ("PERSON", "Made"), ("PERSON", "Bob"), ("PERSON", "The")}
    assert main(["coref", at("er"), "--out", at("coref")]) == 0
    she = next(r for r in lines(tmp_path / "coref" / "all.entities.jsonl") if r["text"] == "She")
    assert she["coref_rule"] == "nearest_compatible" and she["antecedent_mention_id"].startswith("d1:") and she["resolved_entity_id"]
    assert sorted(len(r["mention_ids"]) for r in lines(tmp_path / "coref" / "all.chains.jsonl")) == [1, 1, 1, 1, 2]
    assert main(["fourw", at("coref"), "--normalized", at("norm"), "--out", at("props")]) == 0
    d1 = next(r for r in lines(tmp_path / "props" / "all.docprops.jsonl") if r["doc_id"] == "d1")
    assert d1["what"]["doc_type"] == "pdf" and [w["value"] for w in d1["when"]] == ["2024"] and d1["stats"]["orgs"] == 1
    assert json.loads((tmp_path / "props" / "_reports" / "run_report.json").read_text())["docs"] == 2
    assert main(["link", at("coref"), "--out", at("linked"), "--registry", at("reg")]) == 0
    assert main(["link", at("coref"), "--out", at("linked2"), "--registry", at("reg")]) == 0
    assert (tmp_path / "linked" / "linked.entities.jsonl").read_bytes() == (tmp_path / "linked2" / "linked.entities.jsonl").read_bytes()


def test_linked_lines_are_exact(at, tmp_path):
    (tmp_path / "er").mkdir()
    names = ["IBM", "International Business Machines"]
    write_lines(tmp_path / "er" / "a.entities.jsonl", [{"mention_id": f"d1#e{i + 1}", "type": "ORGANIZATION", "label": n, "doc_id": "d1"} for i, n in enumerate(names)])
    (tmp_path / "w.json").write_text(json.dumps({f"organization|{n.lower()}": [{"scheme": "wikidata", "id": "Q37156"}] for n in names[::-1]}))
    (tmp_path / "u.json").write_text(json.dumps({"organization|international business machines": [{"scheme": "uei", "id": "F7QWJ6AJ7RA3"}]}))
    assert main(["link", at("er"), "--out", at("out"), "--registry", at("reg"), "--wikidata", at("w.json"), "--uei", at("u.json")]) == 0
    # Fixed value: the hash of the two lines this input has to give.
    assert hashlib.sha256((tmp_path / "out" / "linked.entities.jsonl").read_bytes()).hexdigest() == "dec19d74b9c257231b4dec872b71abc7f2d95d6d0b41cf6b62cb78d2c29bba80"


def test_promotion_stages(at, tmp_path):
    linked = write_lines(tmp_path / "linked.jsonl", [{"canonical_id": "s", "type": "kb_System", "labels": ["System"], "key": {"name": "old"}}, {"canonical_id": "s", "type": "kb_System", "labels": ["System", "Asset"], "key": {"name": "S"}, "props": {"p": "1"}}, {"canonical_id": "t", "type": "kb_TRL", "labels": ["TRL"], "key": {"value": 8}}, {"canonical_id": "n", "type": "dbo_Organisation", "labels": ["Organization"], "key": {}}])
    ents = write_lines(tmp_path / "ents.jsonl", [{"mention_id": f"e{i}", "type": "dbo_Organisation", "canonical_id": "n", "doc_id": "d", "sent_id": f"s{i}"} for i in range(2)])
    rel = [{"mention_id": f"m{i}", "predicate": "STARTS_AT_TRL", "subj_canonical_id": "s", "obj_canonical_id": "t", "doc_id": "d", "sent_id": f"s{i}", "confidence": 0.7} for i in range(3)]
    rels = write_lines(tmp_path / "rels.jsonl", rel)
    assert main(["promote", ents, rels, linked, "--out", at("out")]) == 0
    facts, entities = lines(tmp_path / "out" / "facts.relations.jsonl"), lines(tmp_path / "out" / "facts.entities.jsonl")
    assert len(facts) == 1 and facts[0]["evidence"]["ev_count"] == 3 and facts[0]["subj"]["labels"] == ["Asset", "System"]
    assert {e["canonical_id"]: e["key"] for e in entities} == {"s": {"name": "S"}, "t": {"value": "8"}}
    assert [q["reasons"] for q in lines(tmp_path / "out" / "quarantine" / "entities.jsonl")] == [["missing_entity_keys", "missing_keys:uri"]]
    report = json.loads((tmp_path / "out" / "_reports" / "run_report.json").read_text())
    assert report["counts"]["promoted_entities"] == 2 and report["counts"]["quarantined_relations"] == 0
    assert main(["quarantine", at("out", "quarantine"), "--out", at("q.md")]) == 0
    assert "- `uri`: 1" in (tmp_path / "q.md").read_text()
    assert main(["preflight", ents, rels, linked]) == 0
    odd = write_lines(tmp_path / "odd.jsonl", [*rel, rel[0] | {"predicate": "BOGUS"}])
    assert main(["preflight", ents, odd, linked]) == 1
    assert main(["promote", ents, odd, linked, "--out", at("out2"), "--min-ev", "9"]) == 0
    assert sorted(q["reasons"] for q in lines(tmp_path / "out2" / "quarantine" / "relations.jsonl")) == [["below_threshold"], ["below_threshold", "predicate_not_allowed"]]


def test_exit_codes(at, tmp_path):
    assert main(["nonsense"]) == 2 and main([]) == 2
    assert main(["normalize", at("gone"), "--out", at("o")]) == 2
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.json").write_text("{ not: valid json }")
    assert main(["validate", at("bad")]) == 2
    assert main(["normalize", at("bad"), "--out", at("bad", "inside")]) == 2
    assert main(["doctor"]) == 0 and main(["doctor", "--model-path", "/nowhere.gguf"]) == 1 and main(["doctor", "--models-dir", at("bad")]) == 2
