"""Mentions to facts through a semantic contract; quarantine, its summary, and the preflight report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seamark.operators.contract import CONF_THR, MIN_EVIDENCE, VERSION, default, rules, thresholds

__all__ = ["default", "rules", "thresholds"]
MOST_MENTIONS, MOST_EXAMPLES, MOST_SUMMARY = 20, 3, 5
# Predicates whose object, where it is a readiness level, must lie in the level's range.
LEVEL_PREDICATES = ["STARTS_AT_TRL", "ENDS_AT_TRL", "AT_TRL"]


def satisfies(labels: Column, allowed: Column) -> Column:
    return F.coalesce((allowed == F.array(F.lit("*"))) | F.arrays_overlap(labels, allowed), F.lit(False))


def _with(df: DataFrame, **missing: str) -> DataFrame:
    """``df`` with null columns of these types where it has none."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in missing.items() if c not in df.columns})


def last_rows(df: DataFrame, key: str, at: str) -> DataFrame:
    """The last row (by ``at``) of each non-null ``key``."""
    rest = [c for c in df.columns if c != key]
    return df.where(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(key).agg(F.max_by(F.struct(*rest), F.col(at)).alias("r")).select(key, "r.*")


def evidence(mentions: DataFrame, qualify_by_doc: bool = False) -> DataFrame:
    """Per ``subj, predicate, obj``: mean confidence (exact, as decimal), distinct sentences and documents,
    the first 20 mentions, and the props of the first mention (by ``seq``, else by id) that has some. Rows
    with an empty part of the key are skipped. Ranks are limited before anything is gathered."""
    m = _with(mentions, span="array<int>", props="map<string,string>").where("coalesce(subj, '') <> '' AND coalesce(predicate, '') <> '' AND coalesce(obj, '') <> ''")
    key = ["subj", "predicate", "obj"]
    m = m.withColumn("confidence", F.coalesce("confidence", F.lit(0.0)))
    sent = F.nullif(F.col("sent_id"), F.lit(""))
    sent = F.when(sent.isNotNull(), F.struct("doc_id", sent)) if qualify_by_doc else sent
    exact = F.avg(F.col("confidence").cast("decimal(20,17)"))
    at = F.struct(F.col("seq") if "seq" in m.columns else F.col("mention_id"), "mention_id")
    sample = F.min_by(F.when(F.size("props") > 0, F.to_json("props")), F.when(F.size("props") > 0, at))
    counts = m.groupBy(*key).agg(exact.alias("avg_confidence"), F.count_distinct(sent).alias("ev_count"), F.count_distinct(F.nullif(F.col("doc_id"), F.lit(""))).alias("doc_count"), sample.alias("props"))
    order = [F.coalesce(c, F.lit("None")) for c in ("doc_id", "sent_id")] + ["mention_id"]
    first = m.withColumn("r", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col("r") <= MOST_MENTIONS)
    first = first.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("r", "doc_id", "sent_id", "mention_id", "span", "confidence"))).alias("m"))
    first = first.select(*key, F.transform("m", lambda x: F.struct(*[x[c].alias(c) for c in ("doc_id", "sent_id", "mention_id", "span", "confidence")])).alias("mentions"))
    return counts.join(first, key)


def entity_evidence(mentions: DataFrame) -> DataFrame:
    """``canonical_id, ev_count, doc_count, mention_count`` of each id that mentions name."""
    m = mentions.where("coalesce(canonical_id, '') <> ''")
    some = lambda c: F.count_distinct(F.nullif(F.col(c), F.lit("")))
    return m.groupBy("canonical_id").agg(some("sent_id").alias("ev_count"), some("doc_id").alias("doc_count"), F.count(F.lit(1)).alias("mention_count"))


def _checked(canonical: DataFrame, ent: DataFrame) -> DataFrame:
    """``canonical`` with ``known`` (its type is in the contract), ``missing`` (merge keys that are absent or empty),
    ``absent`` (a merge key is not in the key, or a required field neither in key nor props) and ``ok`` (type known,
    value in range)."""
    canonical = _with(canonical, props="map<string,string>")
    rows = canonical.join(F.broadcast(ent.drop("labels")), "type", "left")  # the contract's size
    known = F.col("key_fields").isNotNull()
    has = lambda m, f: F.coalesce(F.map_contains_key(m, f), F.lit(False))
    empty = F.filter("key_fields", lambda f: F.coalesce(F.element_at("key", f), F.lit("")) == "")
    absent = F.exists("key_fields", lambda f: ~has("key", f)) | F.exists("required", lambda f: ~has("key", f) & ~has("props", f))
    value = F.element_at("key", F.lit("value")).try_cast("double")
    in_range = known & F.when(F.col("lo").isNull(), True).otherwise(F.coalesce(value.between(F.col("lo"), F.col("hi")), F.lit(False)))
    missing = F.when(known, F.coalesce(empty, F.col("key_fields"))).otherwise(F.expr("cast(array() as array<string>)"))
    return rows.select(*canonical.columns, known.alias("known"), missing.alias("missing"), F.coalesce(absent, F.lit(True)).alias("absent"), in_range.alias("ok"), F.col("lo").isNotNull().alias("ranged"))


def gate(groups: DataFrame, canonical: DataFrame, contract: tuple[DataFrame, DataFrame], conf_thr: float = CONF_THR, min_ev: int = MIN_EVIDENCE) -> DataFrame:
    """``groups`` with ``reasons``, all gates that a relation fails, sorted; empty for a fact.

    ``canonical`` has ``canonical_id, type, labels, key map<string,string>`` and perhaps ``props``, one row for
    each id (``last_rows`` makes it so)."""
    rel, ent = contract
    ends = _checked(canonical, ent)
    side = lambda p: ends.select(F.col("canonical_id").alias(p), F.sort_array(F.array_distinct("labels")).alias(f"{p}_labels"), F.lit(True).alias(f"{p}_listed"), F.col("missing").alias(f"{p}_missing"), F.col("ok").alias(f"{p}_ok"))
    g = groups.join(side("subj"), "subj", "left").join(side("obj"), "obj", "left").join(F.broadcast(rel), "predicate", "left")
    lost = lambda p: F.col(f"{p}_listed").isNull()
    keys = lambda p, n: F.when(F.size(f"{p}_missing") > 0, F.concat(F.lit(f"missing_keys:{n}:"), F.array_join(f"{p}_missing", ",")))
    fits = satisfies(F.col("subj_labels"), F.col("domain")) & satisfies(F.col("obj_labels"), F.col("range"))
    reasons = F.array_compact(F.array(
        F.when((F.col("avg_confidence") < F.lit(str(conf_thr)).cast("decimal(20,17)")) | (F.col("ev_count") < min_ev), "below_threshold"),
        F.when(F.col("domain").isNull(), "predicate_not_allowed"),
        F.when(lost("subj"), "missing_subject"),
        F.when(lost("obj"), "missing_object"),
        keys("subj", "subject"),
        keys("obj", "object"),
        F.when((~lost("subj") & ~F.col("subj_ok")) | (~lost("obj") & ~F.col("obj_ok")), "type_constraint_failed"),
        F.when(F.col("domain").isNotNull() & ~lost("subj") & ~lost("obj") & ~fits, "domain_range_mismatch"),
        F.when(F.col("domain").isNotNull() & ~lost("subj") & F.col("predicate").isin(LEVEL_PREDICATES) & F.array_contains("obj_labels", "TRL") & ~F.col("obj_ok"), "predicate_constraint_failed"),
    ))
    g = _with(g, props="string")
    return g.select("subj", "subj_labels", "predicate", "obj", "obj_labels", F.col("avg_confidence").cast("double").alias("avg_confidence"), "ev_count", "doc_count", "mentions", "props", F.sort_array(F.array_distinct(reasons)).alias("reasons"))


def facts(gated: DataFrame) -> DataFrame:
    return gated.where(F.size("reasons") == 0).drop("reasons")


def quarantine(gated: DataFrame) -> DataFrame:
    return gated.where(F.size("reasons") > 0).withColumn("examples", F.transform(F.slice("mentions", 1, MOST_EXAMPLES), lambda m: F.struct(m["doc_id"].alias("doc_id"), m["sent_id"].alias("sent_id")))).drop("mentions", "props")


def _policy(conf_thr: float, min_ev: int) -> Column:
    return F.struct(F.lit(float(conf_thr)).alias("conf_thr"), F.lit(int(min_ev)).alias("min_ev"))


def fact_rows(gated: DataFrame, conf_thr: float = CONF_THR, min_ev: int = MIN_EVIDENCE, version: str = VERSION) -> DataFrame:
    """Facts in the form they are written: ``subj, predicate, obj, props, evidence, policy, provenance``."""
    end = lambda p: F.struct(F.col(p).alias("canonical_id"), F.col(f"{p}_labels").alias("labels")).alias(p)
    proof = F.struct("avg_confidence", "ev_count", "doc_count", "mentions").alias("evidence")
    props = F.coalesce(F.from_json("props", "map<string,string>"), F.expr("cast(map() as map<string,string>)")).alias("props")
    return facts(gated).select(end("subj"), "predicate", end("obj"), props, proof, _policy(conf_thr, min_ev).alias("policy"), F.struct(F.lit(version).alias("schema_version")).alias("provenance"))


def quarantine_rows(gated: DataFrame, conf_thr: float = CONF_THR, min_ev: int = MIN_EVIDENCE, version: str = VERSION) -> DataFrame:
    """Quarantined relations in the form they are written."""
    q = gated.where(F.size("reasons") > 0)
    end = lambda p: F.struct(F.col(p).alias("canonical_id")).alias(p)
    proof = F.struct("avg_confidence", "ev_count", "doc_count", "mentions").alias("evidence")
    some = F.transform(F.slice("mentions", 1, MOST_EXAMPLES), lambda m: F.struct(m["doc_id"].alias("doc_id"), m["sent_id"].alias("sent_id"))).alias("examples")
    return q.select(end("subj"), "predicate", end("obj"), F.array("subj", "predicate", "obj").alias("group_key"), proof, _policy(conf_thr, min_ev).alias("policy"), "reasons", some, F.lit("relation").alias("kind"), F.struct(F.lit(version).alias("schema_version")).alias("provenance"))


def _short(c: Column, most: int = 64) -> Column:
    return F.when(F.length(c) <= most, c).otherwise(F.concat(F.substring(c, 1, most - 1), F.lit("…")))


def quarantine_summary(quarantined: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """``kind, name, n, examples``: how often each reason (``reason`` of relations, ``entity_reason``) and each
    ``predicate`` and ``entity_type`` occurs, and each merge key that entities lack (``missing_key``), with up
    to 5 examples, the smallest ones; ``total`` counts the rows themselves."""
    example = _short(F.concat(F.lit("rel:"), F.concat_ws("|", *[F.col(c) if c in quarantined.columns else F.lit("?") for c in ("subj", "predicate", "obj")])))
    take = lambda df, kind, name, ex: df.select(F.lit(kind).alias("kind"), name.alias("name"), ex.alias("example"))
    parts = [take(quarantined, "reason", F.explode("reasons"), example), take(quarantined, "predicate", F.col("predicate"), example), take(quarantined, "total", F.lit("relations"), example)]
    if entities is not None:
        of = _short(F.concat(F.lit("entity:"), "canonical_id"))
        keys = entities.select("canonical_id", F.explode("reasons").alias("reason")).where("reason LIKE 'missing_keys:%'")
        parts += [take(entities, "entity_reason", F.explode("reasons"), of), take(entities, "entity_type", F.col("type"), of), take(entities, "total", F.lit("entities"), of)]
        parts.append(take(keys, "missing_key", F.explode(F.split(F.substring_index("reason", ":", -1), ",")), of))
    rows = reduce(DataFrame.unionByName, parts)
    counts = rows.groupBy("kind", "name").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("kind", "name").orderBy("example"))
    some = rows.withColumn("r", rank).where(F.col("r") <= MOST_SUMMARY).groupBy("kind", "name").agg(F.sort_array(F.collect_list("example")).alias("examples"))
    same = (counts["kind"] == some["kind"]) & counts["name"].eqNullSafe(some["name"])
    return counts.join(some, same).select(counts["kind"], counts["name"], "n", F.when(counts["kind"] != "total", F.col("examples")).alias("examples"))


def entity_candidates(fact_rows: DataFrame, entity_evidence: DataFrame, min_ev: int = MIN_EVIDENCE) -> DataFrame:
    """Distinct ids: ends of facts, and entities with enough evidence of their own."""
    ends = fact_rows.select(F.explode(F.array("subj", "obj")).alias("canonical_id"))
    return ends.unionByName(entity_evidence.where(F.col("ev_count") >= min_ev).select("canonical_id")).distinct()


def gate_entities(candidates: DataFrame, canonical: DataFrame, contract: tuple[DataFrame, DataFrame]) -> DataFrame:
    """``canonical_id, type, labels, key, props, reasons`` of each candidate id; no reasons for a promoted one."""
    rows = candidates.join(_checked(canonical, contract[1]).withColumn("listed", F.lit(True)), "canonical_id", "left")
    listed = F.col("listed").isNotNull()
    reasons = F.array_compact(F.array(
        F.when(~listed, "missing_object"),
        F.when(listed & (F.size("missing") > 0), F.concat(F.lit("missing_keys:"), F.array_join("missing", ","))),
        F.when(listed & F.col("absent"), "missing_entity_keys"),
        F.when(listed & ~F.col("ok"), "type_constraint_failed"),
    ))
    return rows.select("canonical_id", "type", F.sort_array(F.array_distinct("labels")).alias("labels"), "key", "props", F.sort_array(reasons).alias("reasons"))


def promoted_entities(gated_entities: DataFrame) -> DataFrame:
    """Ids of the entities that pass all gates."""
    return gated_entities.where(F.size("reasons") == 0).select("canonical_id")


def quarantined_entities(gated_entities: DataFrame) -> DataFrame:
    return gated_entities.where(F.size("reasons") > 0).drop("key", "props")


def entity_rows(gated_entities: DataFrame, proof: DataFrame, version: str = VERSION) -> DataFrame:
    """Promoted entities in the form they are written, with the evidence (``entity_evidence``) for each."""
    g = gated_entities.where(F.size("reasons") == 0).join(proof, "canonical_id", "left")
    none = F.expr("cast(map() as map<string,string>)")
    of = F.struct(F.lit(version).alias("schema_version"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("ev_count", "doc_count")]).alias("provenance")
    return g.select("canonical_id", "type", "labels", F.coalesce("key", none).alias("key"), F.coalesce("props", none).alias("props"), of)


def preflight(groups: DataFrame, canonical: DataFrame, contract: tuple[DataFrame, DataFrame], conf_thr: float = CONF_THR, min_ev: int = MIN_EVIDENCE) -> DataFrame:
    """One row of counters over all groups; ``blockers`` is what must be zero before promotion."""
    g = gate(groups, canonical, contract, conf_thr, min_ev)
    n = lambda r: F.count_if(F.array_contains("reasons", r))
    c = g.agg(F.count(F.lit(1)).alias("n_groups"), n("below_threshold").alias("below_threshold"), n("predicate_not_allowed").alias("unknown_predicates"), n("type_constraint_failed").alias("out_of_range"), n("domain_range_mismatch").alias("misfits"))
    return c.withColumn("blockers", F.col("unknown_predicates") + F.col("out_of_range") + F.col("misfits"))


def preflight_report(entity_mentions: DataFrame, relation_mentions: DataFrame, canonical: DataFrame, contract: tuple[DataFrame, DataFrame], conf_thr: float = CONF_THR, min_ev: int = MIN_EVIDENCE) -> DataFrame:
    """``kind, name, n``: what stands in the way of promotion.

    Entity mentions (``type, canonical_id``) count under ``unknown_type``, and under ``out_of_range`` where they
    name a readiness level outside its range. A relation group counts once, at the first of: ``unknown_predicate``;
    an end that is not listed (no count); ``domain_range``; else each merge key its ends lack (``missing_key``) and
    ``below_threshold``. ``canon_entities`` and ``relation_groups`` tell the totals. Here "*" anywhere among allowed
    labels takes any, and the mean of confidences is a plain one."""
    rel, ent = contract
    ends = _checked(canonical, ent)
    one = lambda df, kind, name: df.select(F.lit(kind).alias("kind"), name.alias("name"))
    kinds = entity_mentions.join(F.broadcast(ent.select("type", F.lit(True).alias("is_type"))), "type", "left")
    parts = [one(kinds.where("is_type IS NULL"), "unknown_type", F.coalesce("type", F.lit("?")))]
    levels = ends.where(F.col("ranged") & (F.coalesce(F.array_contains("labels", "TRL"), F.lit(False)) | F.col("type").endswith("TRL")) & ~F.col("ok")).select("canonical_id")
    parts.append(one(entity_mentions.select("canonical_id").join(levels, "canonical_id"), "out_of_range", F.lit("TRL")))

    sent = F.nullif(F.col("sent_id"), F.lit(""))
    g = relation_mentions.groupBy("subj", "predicate", "obj").agg(F.avg(F.coalesce("confidence", F.lit(0.0))).alias("avg"), F.count_distinct(sent).alias("ev"))
    parts.append(one(g, "relation_groups", F.lit("all")))
    parts.append(one(canonical, "canon_entities", F.lit("all")))
    side = lambda p: ends.select(F.col("canonical_id").alias(p), F.coalesce("labels", F.expr("cast(array() as array<string>)")).alias(f"{p}_labels"), F.transform("missing", lambda k: F.concat(F.col("type"), F.lit(":"), k)).alias(f"{p}_missing"))
    g = g.join(F.broadcast(rel), "predicate", "left").join(side("subj"), "subj", "left").join(side("obj"), "obj", "left")
    takes = lambda labels, allowed: F.array_contains(allowed, "*") | F.arrays_overlap(labels, allowed)
    parts.append(one(g.where("domain IS NULL"), "unknown_predicate", F.coalesce("predicate", F.lit("None"))))
    g = g.where("domain IS NOT NULL AND subj_labels IS NOT NULL AND obj_labels IS NOT NULL")
    fits = F.coalesce(takes("subj_labels", "domain") & takes("obj_labels", "range"), F.lit(False))
    parts.append(one(g.where(~fits), "domain_range", F.col("predicate")))
    g = g.where(fits)
    parts.append(one(g, "missing_key", F.explode(F.concat("subj_missing", "obj_missing"))))
    parts.append(one(g.where((F.col("avg") < conf_thr) | (F.col("ev") < min_ev)), "below_threshold", F.lit("groups")))
    return reduce(DataFrame.unionByName, parts).groupBy("kind", "name").agg(F.count(F.lit(1)).alias("n"))


# What must be zero before promotion.
BLOCKERS = ["unknown_predicate", "unknown_type", "out_of_range", "domain_range"]


def counters(entity_mentions: DataFrame, gated: DataFrame, gated_entities: DataFrame, relation_mentions: DataFrame) -> DataFrame:
    """One row with the counts of a promotion run."""
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    used = relation_mentions.where("coalesce(subj, '') <> '' AND coalesce(predicate, '') <> '' AND coalesce(obj, '') <> ''")
    ok = lambda c: F.count_if(F.size("reasons") == 0).alias(f"promoted_{c}")
    bad = lambda c: F.count_if(F.size("reasons") > 0).alias(f"quarantined_{c}")
    parts = [n(entity_mentions, "mentions_entities"), n(used, "mentions_relations"), gated.agg(F.count(F.lit(1)).alias("relation_groups"), ok("relations"), bad("relations")), gated_entities.agg(ok("entities"), bad("entities"))]
    return reduce(lambda a, b: a.join(F.broadcast(b)), parts)  # one row each
