"""Mentions to canonical entities, their external ids, and the registry."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamark.functions.text import or_else, strip, uuid5_url
from seamark.operators.embedding import embed_local, index

__all__ = ["embed_local", "index"]

# Fixed value: what stands before type and label in the name that a canonical id is the UUID of.
ID_PREFIX = "combo://entity/"


def canonical_id(kind, label, prefix: str = ID_PREFIX):
    return uuid5_url(F.concat(F.lit(prefix), kind, F.lit("|"), label))


def groups(mentions: DataFrame) -> DataFrame:
    """``doc_id, canonical_id, type, normalized_label, name, mention_ids`` of each group of mentions.

    ``mentions`` has ``mention_id, type, label, doc_id``; the name is the commonest spelling, the
    smaller one on a tie. Counting spellings first keeps hot labels out of single tasks."""
    m = mentions.where("mention_id IS NOT NULL").dropDuplicates(["mention_id"])
    label = F.coalesce("label", F.lit(""))
    return _grouped(m.select("doc_id", "mention_id", F.upper(or_else(strip(F.col("type")), F.lit("UNKNOWN"))).alias("type"), label.alias("label"), F.lower(strip(label)).alias("normalized_label"), strip(label).alias("shown")))


def entity_groups(entities: DataFrame) -> DataFrame:
    """The same of extracted entities (``doc_id, mention_id, type, text`` and perhaps ``label, entity_id,
    resolved_entity_id``): a label stands for the type, and a known entity's id for the text."""
    have = lambda c: F.nullif(F.col(c), F.lit("")) if c in entities.columns else F.lit(None).cast("string")
    text = F.coalesce(have("text"), have("label"), F.lit(""))
    key = F.lower(strip(F.coalesce(have("resolved_entity_id"), have("entity_id"), text)))
    return _grouped(entities.select("doc_id", "mention_id", F.upper(F.coalesce(have("label"), have("type"), F.lit(""))).alias("type"), text.alias("label"), key.alias("normalized_label"), text.alias("shown")))


def _grouped(m: DataFrame) -> DataFrame:
    key = ["doc_id", "type", "normalized_label"]
    spelled = m.groupBy(*key, "label", "shown").agg(F.count(F.lit(1)).alias("n"), F.collect_list("mention_id").alias("ids"))
    g = spelled.groupBy(*key).agg(F.min_by("shown", F.struct(-F.col("n"), "label")).alias("name"), F.sort_array(F.flatten(F.collect_list("ids"))).alias("mention_ids"))
    return g.select("doc_id", canonical_id(F.col("type"), F.col("normalized_label")).alias("canonical_id"), "type", "normalized_label", "name", "mention_ids")


def _label(c):
    return F.lower(strip(c))


def external_ids(linked: DataFrame, cache: DataFrame, source: str, only_types: tuple[str, ...] = ()) -> DataFrame:
    """Left join of groups to a cache (``key, id`` and perhaps ``pos``): adds ``source, external_id``. A key is
    a name or a kind, '|' and a name; of keys that come to one name the last counts (by ``pos``, else the
    largest id). Spark chooses how to join."""
    at = F.struct("pos", "id") if "pos" in cache.columns else F.col("id")
    c = cache.select(F.regexp_replace(_label(F.col("key")), r"^[^|]*\|", "").alias("normalized_name"), "*")
    c = c.groupBy("normalized_name").agg(F.max_by("id", at).alias("external_id"))
    out = linked.withColumn("normalized_name", _label(F.col("name"))).join(c, "normalized_name", "left").drop("normalized_name").withColumn("source", F.lit(source))
    return out.withColumn("external_id", F.when(F.col("type").isin(*only_types), F.col("external_id"))) if only_types else out


def linked_rows(linked: DataFrame, with_ids: list[DataFrame]) -> DataFrame:
    """Groups in the form they are written: ``doc_id, canonical_id, type, name, mention_ids, external_ids``.
    ``with_ids``: results of ``external_ids``."""
    base = linked.select("doc_id", "canonical_id", "type", "name", "mention_ids")
    found = [x.where("external_id IS NOT NULL").select("doc_id", "canonical_id", F.struct("source", F.col("external_id").alias("id")).alias("e")) for x in with_ids]
    none = F.expr("cast(array() as array<struct<source:string,id:string>>)")
    if not found:
        return base.withColumn("external_ids", none)
    ids = reduce(DataFrame.unionByName, found).groupBy("doc_id", "canonical_id").agg(F.array_sort(F.collect_set("e")).alias("ids"))
    same = base["doc_id"].eqNullSafe(ids["doc_id"]) & (base["canonical_id"] == ids["canonical_id"])
    return base.join(ids, same, "left").select(base["doc_id"], base["canonical_id"], "type", "name", "mention_ids", F.coalesce("ids", none).alias("external_ids"))


def register(linked: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``canonical_id, type, normalized_label, primary_name``: known rows win, new ones are added once."""
    new = linked.groupBy("type", "normalized_label").agg(F.min("canonical_id").alias("canonical_id"), F.min("name").alias("primary_name")).select("canonical_id", "type", "normalized_label", "primary_name")
    if known is None:
        return new
    return known.unionByName(new.join(known.select("type", "normalized_label"), ["type", "normalized_label"], "left_anti"))


def register_aliases(linked: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``canonical_id, alias``: every name of each entity once."""
    new = linked.where("name <> ''").select("canonical_id", F.col("name").alias("alias")).distinct()
    return new if known is None else known.unionByName(new.join(known, ["canonical_id", "alias"], "left_anti"))


def register_external_ids(found: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``canonical_id, source, external_id``: one owner for each source and id; a known one stays, of new ones
    the smallest canonical_id."""
    new = found.where("coalesce(external_id, '') <> ''").groupBy("source", "external_id").agg(F.min("canonical_id").alias("canonical_id")).select("canonical_id", "source", "external_id")
    return new if known is None else known.unionByName(new.join(known.select("source", "external_id"), ["source", "external_id"], "left_anti"))
