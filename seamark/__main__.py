"""Command line: ``python -m seamark STAGE ...`` reads and writes folders of JSON files.

Exit codes: 0 done; 1 an error, or blockers found by ``preflight``; 2 a wrong command line, or input that
cannot be read or is not valid.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import tempfile
import traceback

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seamark.functions.dist import release
from seamark.operators import contract, embedding, entities, linking, normalize, promotion, properties
from seamark.plans import reports
from seamark.sources import files

MENTION = "id string, chunk_id string, doc_id string, type string, text string, start int, end int, conf double, source_sha1 string, mention_id string, label string, entity_id string, resolved_entity_id string, antecedent_mention_id string, is_pronoun boolean, normalized string, grain string, n int"
CANONICAL = "canonical_id string, type string, labels array<string>, key map<string,string>, props map<string,string>"
ENTITY_MENTION = "mention_id string, type string, canonical_id string, doc_id string, sent_id string, confidence double"
RELATION_MENTION = "mention_id string, predicate string, subj_canonical_id string, obj_canonical_id string, doc_id string, sent_id string, span array<int>, confidence double, props map<string,string>"
EMBEDDED = "doc_id string, chunk_id string, truncated boolean, model string, dim int, text_sha1 string, embedding array<double>"
NORMALIZED = "doc struct<doc_id:string,source_path:string,pages:array<string>>, chunks array<struct<doc_id:string,chunk_id:string,text:string>>"


class Invalid(Exception):
    """Input that cannot be used: exit code 2."""


def _session() -> SparkSession:
    b = SparkSession.builder.appName("seamark").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false")
    s = SparkSession.getActiveSession() or b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    return s


def _apart(source: str, out: str) -> None:
    a, b = os.path.realpath(source), os.path.realpath(out)
    if b == a or b.startswith(a + os.sep):
        raise Invalid("the output may not lie in the input")


def _lines(df: DataFrame, path: str, by: str | None = None) -> None:
    """One sorted file of JSON lines; rows reach it one partition at a time."""
    with tempfile.TemporaryDirectory(dir=os.path.dirname(os.path.abspath(path))) as t:
        files.write_json_lines(df, f"{t}/rows", spaced=True, by=by)
        with open(f"{t}/whole", "w", encoding="utf-8", newline="") as f:
            f.writelines(line + "\n" for line in files.lines_text(df.sparkSession, f"{t}/rows"))
        os.replace(f"{t}/whole", path)


def _report(row: dict, path: str) -> None:
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(row, f, ensure_ascii=False, sort_keys=True, indent=2)


def _normalized(s: SparkSession, folder: str) -> DataFrame:
    return s.read.schema(NORMALIZED).option("multiLine", True).option("pathGlobFilter", "*.json").json(folder)


def _documents(s: SparkSession, folder: str) -> DataFrame:
    return _normalized(s, folder).select("doc.*").where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])


def run_normalize(s: SparkSession, a: argparse.Namespace) -> int:
    _apart(a.input, a.out)
    raw = files.extracted_json(s, a.input)
    names = raw.withColumn("name", files.safe_name(F.col("source_path"), F.col("item")))
    docs = normalize.coerce(names).join(names.groupBy("doc_id").agg(F.min("name").alias("name"), F.first("images").alias("images")), "doc_id", "left")
    sents = normalize.sentences(docs)
    whole = normalize.normalized(docs, sents, normalize.chunks(sents, a.max_tokens)).join(docs.select("doc_id", "name"), "doc_id")
    os.makedirs(a.out, exist_ok=True)
    n = 0
    for r in whole.select("name", F.to_json(F.struct("meta", "doc", "sentences", "chunks", "images"), {"ignoreNullFields": "false"}).alias("v")).toLocalIterator():
        with open(os.path.join(a.out, f"{r['name']}.normalized.json"), "w", encoding="utf-8") as f:
            json.dump(json.loads(r["v"]), f, ensure_ascii=False, sort_keys=True, indent=2)
        n += 1
    if not n:
        raise Invalid("no document could be read")
    return 0


def run_validate(s: SparkSession, a: argparse.Namespace) -> int:
    texts = s.read.text(a.input, wholetext=True, pathGlobFilter="*.json").select(F.regexp_extract(F.input_file_name(), r"([^/]*)$", 1).alias("name"), "value")
    bad = normalize.schema_violations(texts).collect()
    for r in bad:
        print(f"{r['name']}: {r['rule']}")
    if bad:
        return 2
    nested = s.read.schema("doc struct<doc_id:string,pages:array<string>>, sentences array<struct<doc_id:string,sent_id:string,page:int,text:string,char_start:int,char_end:int>>, chunks array<struct<doc_id:string,chunk_id:string,text:string,sentence_ids:array<string>,page_start:int,page_end:int>>").option("multiLine", True).option("pathGlobFilter", "*.json").json(a.input)
    rows = normalize.violations(nested.select("doc.*"), nested.select(F.explode("sentences").alias("s")).select("s.*"), nested.select(F.explode("chunks").alias("c")).select("c.*"), a.max_tokens)
    found = 0
    for r in rows.toLocalIterator():
        print(f"{r['doc_id']}: {r['rule']} {r['item']}")
        found = 2
    return found


def run_embed(s: SparkSession, a: argparse.Namespace) -> int:
    chunks = _normalized(s, a.input).select(F.explode("chunks").alias("c")).select("c.*").dropDuplicates(["chunk_id"])
    make, name, dim = None, a.model, a.dim
    if a.model_path or a.models_dir:
        path = a.model_path or embedding.pick_model(embedding.model_files(a.models_dir))
        if not path:
            raise Invalid("no model file in the folder")
        make = lambda: embedding.FileModel(path)
        ok = embedding.health(make)
        if ok["ok"]:
            name, dim = ok["model"], ok["dim"]
        elif not a.fall_back:
            raise Invalid(ok["error"])
        else:
            make = None
    os.makedirs(a.out, exist_ok=True)
    path = os.path.join(a.out, "chunks.embedded.jsonl")
    done = s.read.schema(EMBEDDED).json(path) if os.path.exists(path) else None
    rows = embedding.embed(chunks, make, dim, name, a.max_tokens, done, a.batch)
    _lines(rows if done is None else rows.unionByName(done), path)
    _report(reports.counts(rows=s.read.schema(EMBEDDED).json(path)).first().asDict() | {"model": name, "dim": dim, "errors": 0}, os.path.join(a.out, "manifest.json"))
    return 0


def run_doctor(s: SparkSession, a: argparse.Namespace) -> int:
    path = a.model_path or (embedding.pick_model(embedding.model_files(a.models_dir)) if a.models_dir else None)
    if a.models_dir and not path:
        raise Invalid("no model file in the folder")
    got = embedding.health((lambda: embedding.FileModel(path)) if path else (lambda: embedding.LocalModel(a.dim, a.model)))
    print(json.dumps(got, sort_keys=True))
    return 0 if got["ok"] else 1


def run_index(s: SparkSession, a: argparse.Namespace) -> int:
    embedding.index(s.read.schema(EMBEDDED).option("pathGlobFilter", "*.jsonl").json(a.input)).write.mode("overwrite").parquet(a.out)
    return 0


def run_er(s: SparkSession, a: argparse.Namespace) -> int:
    chunks = _normalized(s, a.normalized).select(F.explode("chunks").alias("c")).select("c.*")
    used = entities.embedded_chunks(s.read.schema(EMBEDDED).option("pathGlobFilter", "*.embedded.jsonl").json(a.input), chunks)
    found = entities.extract(used)
    os.makedirs(a.out, exist_ok=True)
    _lines(found, os.path.join(a.out, "all.entities.jsonl"))
    links = entities.links(found)
    _lines(links, os.path.join(a.out, "all.rels.jsonl"))
    _report(reports.counts(entities=found, relations=links).first().asDict(), os.path.join(a.out, "manifest.json"))
    return 0


def run_coref(s: SparkSession, a: argparse.Namespace) -> int:
    e = files.entity_lines(s, a.input, MENTION).withColumn("ord", F.col("chunk_id"))
    m = entities.numbered(e.drop("mention_id", "antecedent_mention_id", "resolved_entity_id", "n"))
    r = entities.resolve(m, a.window_sentences, a.window_mentions)
    ids = m.select(F.col("mention_id").alias("antecedent_mention_id"), F.coalesce("id", "mention_id").alias("resolved_entity_id"))
    out = entities.features(m).join(r.join(ids, "antecedent_mention_id", "left"), ["doc_id", "mention_id"], "left")
    chains = entities.chains(m, r)
    os.makedirs(a.out, exist_ok=True)
    _lines(out.drop("form", "estimate", "device", "doc_base"), os.path.join(a.out, "all.entities.jsonl"))
    listed = chains.join(m.select("mention_id", "n"), "mention_id").groupBy("doc_id", "chain_id").agg(F.array_sort(F.collect_list(F.struct("n", "mention_id"))).alias("m"))
    _lines(listed.select("doc_id", "chain_id", F.transform("m", lambda x: x["mention_id"]).alias("mention_ids")), os.path.join(a.out, "all.chains.jsonl"))
    _report(reports.coreference_report(r, chains).first().asDict(), os.path.join(a.out, "_reports", "run_report.json"))
    return 0


def run_fourw(s: SparkSession, a: argparse.Namespace) -> int:
    docs = _documents(s, a.normalized) if a.normalized else s.createDataFrame([], "doc_id string, source_path string, pages array<string>")
    m = files.entity_lines(s, a.input, MENTION).withColumn("mention_id", F.coalesce("mention_id", "id"))
    m = properties.rank_in_document(m.drop("n"), "chunk_id", "start", "end", "mention_id")
    os.makedirs(a.out, exist_ok=True)
    how = (a.min_things, a.other_things, a.things.split(",") if a.things else None)
    _lines(properties.document_properties(m, docs, *how), os.path.join(a.out, "all.docprops.jsonl"))
    g = properties.groups(m, *how)
    top = {f"top_{b}": [[r["name"], r["n"]] for r in properties.top_names(g, b).collect()] for b in ("people", "orgs")}
    totals = properties.statistics(m, docs, *how).agg(*[F.sum(c).alias(c) for c in ("persons", "orgs", "dates", "locations", "things")], F.count(F.lit(1)).alias("docs")).first().asDict()
    _report(totals | top, os.path.join(a.out, "_reports", "run_report.json"))
    return 0


def run_link(s: SparkSession, a: argparse.Namespace) -> int:
    m = files.entity_lines(s, a.input, MENTION)
    g = linking.entity_groups(m.withColumn("mention_id", F.coalesce("mention_id", "id")))
    found = [linking.external_ids(g, files.id_cache(s, path), name, only) for name, path, only in (("wikidata", a.wikidata, ()), ("uei", a.uei, ("ORG", "ORGANIZATION"))) if path]
    os.makedirs(a.out, exist_ok=True)
    _lines(linking.linked_rows(g, found), os.path.join(a.out, "linked.entities.jsonl"))
    kept = lambda n: s.read.parquet(os.path.join(a.registry, n)) if os.path.exists(os.path.join(a.registry, n)) else None
    tables = {"entities": linking.register(g, kept("entities")), "aliases": linking.register_aliases(g, kept("aliases"))}
    for x in found:
        tables["external_ids"] = linking.register_external_ids(x.select("canonical_id", "source", "external_id"), tables.get("external_ids") if "external_ids" in tables else kept("external_ids"))
    for name, df in tables.items():  # beside the old one first: it is read while the new one is written
        df.write.mode("overwrite").parquet(os.path.join(a.registry, f"{name}.new"))
        _replace(os.path.join(a.registry, f"{name}.new"), os.path.join(a.registry, name))
    _report(reports.counts(entities=g).first().asDict() | {"errors": 0}, os.path.join(a.out, "_reports", "run_report.json"))
    return 0


def _replace(new: str, old: str) -> None:
    import shutil

    if os.path.exists(old):
        shutil.rmtree(old)
    os.rename(new, old)


def _promotion_input(s: SparkSession, a: argparse.Namespace):
    c = contract.load(a.schema) if a.schema else contract.default()
    placed = lambda path, schema: s.read.text(path).withColumn("seq", F.monotonically_increasing_id()).where("trim(value) <> ''").select("seq", F.from_json("value", schema).alias("r")).select("seq", "r.*")
    canonical = promotion.last_rows(placed(a.linked, CANONICAL), "canonical_id", "seq").drop("seq")
    rel = placed(a.relations, RELATION_MENTION).withColumnsRenamed({"subj_canonical_id": "subj", "obj_canonical_id": "obj"})
    return c, contract.rules(s, c), contract.thresholds(c, a.conf_thr, a.min_ev), canonical, placed(a.entities, ENTITY_MENTION), rel


def run_promote(s: SparkSession, a: argparse.Namespace) -> int:
    c, rules, (conf, ev), canonical, ents, rel = _promotion_input(s, a)
    version = str(c.get("schema_version", "0.0.0"))
    gated = promotion.gate(promotion.evidence(rel), canonical, rules, conf, ev)
    proof = promotion.entity_evidence(ents)
    ge = promotion.gate_entities(promotion.entity_candidates(promotion.facts(gated), proof, ev), canonical, rules)
    os.makedirs(os.path.join(a.out, "quarantine"), exist_ok=True)
    _lines(promotion.entity_rows(ge, proof, version), os.path.join(a.out, "facts.entities.jsonl"))
    _lines(promotion.fact_rows(gated, conf, ev, version), os.path.join(a.out, "facts.relations.jsonl"))
    _lines(promotion.quarantined_entities(ge), os.path.join(a.out, "quarantine", "entities.jsonl"))
    _lines(promotion.quarantine_rows(gated, conf, ev, version), os.path.join(a.out, "quarantine", "relations.jsonl"))
    counts = promotion.counters(ents, gated, ge, rel).first().asDict()
    _report({"schema_version": version, "conf_thr": conf, "min_ev": ev, "counts": counts, "errors": 0}, os.path.join(a.out, "_reports", "run_report.json"))
    return 0


def run_preflight(s: SparkSession, a: argparse.Namespace) -> int:
    _, rules, (conf, ev), canonical, ents, rel = _promotion_input(s, a)
    r = promotion.preflight_report(ents, rel, canonical, rules, conf, ev)
    print(reports.markdown("Preflight", r, {"unknown_predicate": "Unknown predicates", "unknown_type": "Unknown entity types", "domain_range": "Domain or range mismatches", "missing_key": "Missing merge keys", "out_of_range": "Levels out of range", "below_threshold": "Groups below the thresholds"}))
    return 1 if r.where(F.col("kind").isin(promotion.BLOCKERS)).count() else 0


def run_quarantine(s: SparkSession, a: argparse.Namespace) -> int:
    rel = s.read.schema("group_key array<string>, reasons array<string>").json(os.path.join(a.input, "relations.jsonl"))
    rel = rel.select(*[F.coalesce(F.get("group_key", F.lit(i)), F.lit("?")).alias(c) for i, c in enumerate(("subj", "predicate", "obj"))], F.coalesce("reasons", F.expr("cast(array() as array<string>)")).alias("reasons"))
    ent = s.read.schema("canonical_id string, type string, reasons array<string>").json(os.path.join(a.input, "entities.jsonl"))
    text = reports.markdown("Quarantine", promotion.quarantine_summary(rel, ent), {"total": "Rows", "reason": "Reasons of relations", "entity_reason": "Reasons of entities", "predicate": "Relations by predicate", "missing_key": "Missing merge keys of entities"})
    os.makedirs(os.path.dirname(os.path.abspath(a.out)), exist_ok=True)
    with open(a.out, "w", encoding="utf-8") as f:
        f.write(text + "\n")
    return 0


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="seamark", description=__doc__)
    sub = p.add_subparsers(dest="stage", required=True)

    def stage(name, run, *inputs, out=True, **options):
        q = sub.add_parser(name)
        for i in inputs:
            q.add_argument(i)
        if out:
            q.add_argument("--out", required=True)
        for o, default in options.items():
            kind = {"action": "store_true"} if default is False else {"default": default, "type": type(default) if default is not None and not isinstance(default, type) else (default or str)}
            if isinstance(default, type):
                kind["default"] = None
            q.add_argument("--" + o.replace("_", "-"), **kind)
        q.set_defaults(run=run)

    stage("normalize", run_normalize, "input", max_tokens=normalize.MAX_TOKENS)
    stage("validate", run_validate, "input", out=False, max_tokens=normalize.MAX_TOKENS)
    stage("embed", run_embed, "input", model="local-deterministic", dim=64, max_tokens=512, batch=embedding.BATCH, model_path=None, models_dir=None, fall_back=False)
    stage("doctor", run_doctor, out=False, model="local-deterministic", dim=64, model_path=None, models_dir=None)
    stage("index", run_index, "input")
    stage("er", run_er, "input", normalized=None)
    stage("coref", run_coref, "input", window_sentences=3, window_mentions=30)
    stage("fourw", run_fourw, "input", normalized=None, min_things=1, other_things=False, things=None)
    stage("link", run_link, "input", registry="registry", wikidata=None, uei=None)
    stage("promote", run_promote, "entities", "relations", "linked", schema=None, conf_thr=float, min_ev=int)
    stage("preflight", run_preflight, "entities", "relations", "linked", out=False, schema=None, conf_thr=float, min_ev=int)
    stage("quarantine", run_quarantine, "input")
    return p


def main(argv: list[str] | None = None) -> int:
    try:
        a = _parser().parse_args(argv)
    except SystemExit as e:
        return int(e.code or 0)
    for given in (getattr(a, k, None) for k in ("input", "entities", "relations", "linked", "normalized")):
        if given and not os.path.exists(given):
            print(f"not found: {given}", file=sys.stderr)
            return 2
    s = _session()
    try:
        return a.run(s, a)
    except Invalid as e:
        print(e, file=sys.stderr)
        return 2
    except Exception:
        traceback.print_exc()
        return 1
    finally:
        release(s)


if __name__ == "__main__":
    raise SystemExit(main())
