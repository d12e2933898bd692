"""Properties of documents: who, what, when, where and how, from mentions and what is known of the document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seamark.functions.text import or_else, strip

# Types of mentions that name a thing.
THINGS = [
    "DEVICE", "PRODUCT", "EQUIPMENT", "VEHICLE", "WEAPON", "SYSTEM", "PLATFORM", "TOOL",
    "SOFTWARE", "HARDWARE", "COMPONENT", "MATERIAL", "SENSOR", "PAYLOAD", "AIRCRAFT", "VESSEL",
    "SHIP", "BOAT", "UAV", "UAS", "DRONE", "SATELLITE", "MISSILE", "PROTOTYPE", "MODEL",
    "ALGORITHM", "METHOD", "PROCESS",
]
PLACES, TIMES = ["GPE", "LOCATION", "FACILITY"], ["DATE", "TIME"]
# Kinds of documents by media type and by suffix.
MEDIA = {
    "application/pdf": "pdf",
    "application/vnd.openxmlformats-officedocument.presentationml.presentation": "presentation",
    "application/vnd.ms-powerpoint": "presentation",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": "document",
    "application/msword": "document",
    "text/plain": "text",
}
SUFFIXES = {"pdf": "pdf", "ppt": "presentation", "pptx": "presentation", "doc": "document", "docx": "document", "txt": "text"}
# The three forms of dates, in their order.
DATES = [
    r"\b(?:20\d{2}|19\d{2})-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])\b",
    r"(?i)\b(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\s+\d{1,2},\s*(?:20\d{2}|19\d{2})\b",
    r"\b(?:20\d{2}|19\d{2})\b",
]
COLUMNS = {"label": "string", "normalized": "string", "grain": "string", "resolved_entity_id": "string", "entity_id": "string", "source_sha1": "string"}


def normal_name(c: Column) -> Column:
    """A thing's name without article, in lower case, plural endings taken off."""
    low = F.lower(F.regexp_replace(strip(F.coalesce(c, F.lit(""))), r"(?iU)^(the|a|an)\s+", ""))
    long = F.length(low) > 3
    cut = lambda n: F.substring(low, F.lit(1), F.length(low) - n)
    return F.when(low.endswith("ies") & long, F.concat(cut(3), F.lit("y"))).when(low.endswith("ses") & long, cut(2)).when(low.endswith("s") & ~low.endswith("ss"), cut(1)).otherwise(low)


def doc_types(docs: DataFrame) -> DataFrame:
    """``doc_id, filename, doc_type``: pdf, presentation, document or text, by media type (``mime``, where there
    is one) or suffix; null for any other."""
    name = F.regexp_extract(F.coalesce("source_path", F.lit("")), r"([^/]*)$", 1)
    table = lambda m: F.create_map(*[F.lit(x) for kv in m.items() for x in kv])
    suffix = F.regexp_extract(F.lower(name), r"\.([a-z]+)$", 1)
    by_media = F.element_at(table(MEDIA), F.col("mime")) if "mime" in docs.columns else F.lit(None).cast("string")
    return docs.select("doc_id", F.nullif(name, F.lit("")).alias("filename"), F.coalesce(by_media, F.element_at(table(SUFFIXES), suffix)).alias("doc_type"))


def fallback_dates(docs: DataFrame, most: int = 5, dated: DataFrame | None = None) -> DataFrame:
    """``doc_id, ord, value, grain``: up to ``most`` dates of page 1 of documents that no mention dates
    (``dated``: ``doc_id``): ISO dates, then spelled ones, then bare years."""
    if dated is not None:
        docs = docs.join(dated.select("doc_id").distinct(), "doc_id", "left_anti")
    first = F.coalesce(F.get("pages", F.lit(0)), F.lit(""))
    found = F.slice(F.concat(*[F.regexp_extract_all(first, F.lit(f), F.lit(0)) for f in DATES]), 1, most)
    return docs.select("doc_id", F.posexplode(found).alias("ord", "value")).select("doc_id", "ord", "value", F.when(F.length("value") == 4, "year").otherwise("day").alias("grain"))


def _mentions(mentions: DataFrame) -> DataFrame:
    m = mentions.withColumns({c: F.lit(None).cast(t) for c, t in COLUMNS.items() if c not in mentions.columns})
    kind = F.upper(F.coalesce(F.nullif("label", F.lit("")), "type", F.lit("")))
    return m.withColumns({"kind": kind, "entity": or_else(F.col("resolved_entity_id"), F.nullif("entity_id", F.lit("")))})


def groups(mentions: DataFrame, least_things: int = 1, other_things: bool = False, things: list[str] | None = None) -> DataFrame:
    """``doc_id, bucket, key, name, class, entity_id, n, mention_ids`` for the buckets people, orgs and things.

    ``mentions`` has ``doc_id, mention_id, type, text, n`` (``n`` its place in the document), and perhaps label,
    resolved_entity_id and entity_id. One entity is one row: by its id, else (things) by its normal name, else
    by mention. Name and class are those of the first mention."""
    m = _mentions(mentions)
    thing = F.col("kind").isin([t.upper() for t in things or THINGS]) | (F.lit(other_things) & (F.col("kind") == "OTHER"))
    bucket = F.when(F.col("kind") == "PERSON", "people").when(F.col("kind") == "ORG", "orgs").when(thing & ~F.col("kind").isin(PLACES + TIMES), "things")
    key = F.coalesce("entity", F.nullif("mention_id", F.lit("")), F.lower(F.coalesce("text", F.lit(""))))
    key = F.when(F.col("bucket") == "things", F.coalesce("entity", F.nullif(normal_name(F.col("text")), F.lit("")), "mention_id")).otherwise(key)
    m = m.withColumn("bucket", bucket).where("bucket IS NOT NULL").withColumn("key", key)
    at = F.struct("n", "mention_id")
    first = lambda c: F.min_by(c, at)
    g = m.groupBy("doc_id", "bucket", "key").agg(first("text").alias("name"), first("kind").alias("class"), F.first("entity", True).alias("entity_id"), F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(F.struct("n", "mention_id"))).alias("m"))
    g = g.withColumn("mention_ids", F.transform("m", lambda x: x["mention_id"])).drop("m")
    return g.where((F.col("bucket") != "things") | (F.col("n") >= least_things))


def places_and_times(mentions: DataFrame) -> DataFrame:
    """``doc_id, bucket, n, value, grain, mention_id``: each mention of a place (``where``) or a time (``when``)."""
    m = _mentions(mentions).where(F.col("kind").isin(PLACES + TIMES))
    time = F.col("kind").isin(TIMES)
    return m.select("doc_id", F.when(time, "when").otherwise("where").alias("bucket"), "n", F.when(time, or_else(F.col("normalized"), F.col("text"))).otherwise(F.col("text")).alias("value"), F.when(time, F.coalesce(F.nullif("grain", F.lit("")), F.lit("unknown"))).otherwise(F.col("kind")).alias("grain"), "mention_id")


def statistics(mentions: DataFrame, docs: DataFrame, least_things: int = 1, other_things: bool = False, things: list[str] | None = None) -> DataFrame:
    """``doc_id, persons, orgs, dates, locations, things, mentions_total`` of each document that is known or mentioned."""
    m = _mentions(mentions)
    g = groups(mentions, least_things, other_things, things).groupBy("doc_id").agg(F.count_if(F.col("bucket") == "people").alias("persons"), F.count_if(F.col("bucket") == "orgs").alias("orgs"), F.count_if(F.col("bucket") == "things").alias("things"))
    p = places_and_times(mentions)
    w = p.groupBy("doc_id").agg(F.count_if(F.col("bucket") == "when").alias("times"), F.count_if(F.col("bucket") == "where").alias("locations"))
    fall = fallback_dates(docs, dated=p.where("bucket = 'when'")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("fall"))
    total = m.groupBy("doc_id").agg(F.count(F.lit(1)).alias("mentions_total"))
    every = docs.select("doc_id").unionByName(total.select("doc_id")).distinct()
    out = every
    for side in (g, w, fall, total):
        out = out.join(side, "doc_id", "left")
    n = lambda c: F.coalesce(c, F.lit(0))
    return out.select("doc_id", n("persons").alias("persons"), n("orgs").alias("orgs"), (n("times") + n("fall")).alias("dates"), n("locations").alias("locations"), n("things").alias("things"), n("mentions_total").alias("mentions_total"))


def document_properties(mentions: DataFrame, docs: DataFrame, least_things: int = 1, other_things: bool = False, things: list[str] | None = None) -> DataFrame:
    """One nested row for each document with mentions: ``doc_id, source_sha1, who, what, when, where, how, stats``.

    What is known of a document (``docs``: ``doc_id, source_path, pages``) joins from the left; a document that is
    not known has only its id."""
    g = groups(mentions, least_things, other_things, things)
    slot = F.struct((-F.col("n")).alias("o"), F.coalesce("name", F.lit("")).alias("name"), F.col("class"), "entity_id", F.col("n").alias("count"), "mention_ids")
    whole = lambda b: F.transform(F.array_sort(F.collect_list(F.when(F.col("bucket") == b, slot))), lambda x: F.struct(x["name"].alias("name"), x["class"].alias("class"), x["entity_id"].alias("entity_id"), x["count"].alias("count"), x["mention_ids"].alias("mention_ids")))
    who = g.groupBy("doc_id").agg(whole("people").alias("people"), whole("orgs").alias("orgs"), whole("things").alias("things"))
    p = places_and_times(mentions)
    listed = lambda b: F.transform(F.array_sort(F.collect_list(F.when(F.col("bucket") == b, F.struct("n", "mention_id", "value", "grain")))), lambda x: F.struct(x["value"].alias("value"), x["grain"].alias("grain"), F.array(x["mention_id"]).alias("mention_ids")))
    told = p.groupBy("doc_id").agg(listed("when").alias("told"), listed("where").alias("where"))
    fall = fallback_dates(docs, dated=p.where("bucket = 'when'")).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("ord", "value", "grain"))).alias("f"))
    fall = fall.select("doc_id", F.transform("f", lambda x: F.struct(x["value"].alias("value"), x["grain"].alias("grain"), F.expr("cast(array() as array<string>)").alias("mention_ids"))).alias("fall"))
    meta = doc_types(docs).join(docs.select("doc_id", F.sha1(F.array_join("pages", "")).alias("doc_sha1")), "doc_id")
    head = _mentions(mentions).groupBy("doc_id").agg(F.min_by("source_sha1", F.struct("n", "mention_id")).alias("sha"), F.count(F.lit(1)).alias("mentions_total"))
    out = head
    for side in (who, told, fall, meta):
        out = out.join(side, "doc_id", "left")
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    when = F.when(size("told") > 0, F.col("told")).otherwise(F.col("fall"))
    return out.select(
        "doc_id",
        F.coalesce("sha", "doc_sha1").alias("source_sha1"),
        F.struct("people", "orgs").alias("who"),
        F.struct("doc_type", "filename").alias("what"),
        when.alias("when"),
        F.col("where"),
        F.struct("things").alias("how"),
        F.struct(size("people").alias("persons"), size("orgs").alias("orgs"), F.greatest(size(when), F.lit(0)).alias("dates"), size("where").alias("locations"), size("things").alias("things"), "mentions_total").alias("stats"),
    )


def top_names(grouped: DataFrame, bucket: str, most: int = 10) -> DataFrame:
    """``name, n``: the most mentioned names of a bucket over all documents, smaller names first among equals; an
    empty name counts for its place and is left out after."""
    g = grouped.where(F.col("bucket") == bucket).select(F.coalesce("name", F.lit("")).alias("name"), "n")
    return g.groupBy("name").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "name").limit(most).where("name <> ''")


def rank_in_document(mentions: DataFrame, *order: str) -> DataFrame:
    """``mentions`` with ``n``, their place in the document."""
    return mentions.withColumn("n", F.row_number().over(Window.partitionBy("doc_id").orderBy(*order)))
