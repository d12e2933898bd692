"""Pattern entities and links in chunks; coreference inside a document."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seamark.functions.text import matches, short_sha1, strip

# What each type of entity looks like.
PATTERNS = {
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "URL": r"(?U)https?://[^\s\x1c-\x1f]+|www\.[^\s\x1c-\x1f]+",
    "ORG": r"(?U)\b[A-Z]{2,}\b",
    "PERSON": r"(?U)\b[A-Z][a-z]+\b",
}
# Pronouns (number, gender) and given names that tell a gender.
PRONOUNS = {
    "he": ("singular", "masc"),
    "him": ("singular", "masc"),
    "she": ("singular", "fem"),
    "her": ("singular", "fem"),
    "it": ("singular", "neut"),
    "this": ("singular", "neut"),
    "that": ("singular", "neut"),
    "they": ("plural", "unknown"),
    "them": ("plural", "unknown"),
    "these": ("plural", "neut"),
    "those": ("plural", "neut"),
}
FEM = ["jane", "alice", "mary", "anna", "susan", "kate", "karen", "linda"]
MASC = ["bob", "john", "michael", "tom", "david", "peter", "paul"]
# Words that tell a device.
DEVICE_WORDS = ["drone", "system", "device", "battery", "pack", "railgun", "prototype"]


def extract(chunks: DataFrame, *keep: str) -> DataFrame:
    """``id, doc_id, chunk_id, type, text, start, end, conf, source_sha1`` of every entity in a chunk, and the chunk's columns ``keep``."""
    found = [chunks.select("doc_id", "chunk_id", *keep, F.sha1("text").alias("source_sha1"), F.lit(t).alias("type"), F.explode(matches(F.col("text"), p)).alias("m")) for t, p in PATTERNS.items()]
    e = reduce(DataFrame.unionByName, found).select("doc_id", "chunk_id", "type", F.col("m.text").alias("text"), F.col("m.a").alias("start"), (F.col("m.a") + F.length("m.text")).alias("end"), F.lit(0.8).alias("conf"), "source_sha1", *keep)
    return e.withColumn("id", short_sha1("doc_id", "chunk_id", "start", "end", "text"))


def embedded_chunks(embedded: DataFrame, chunks: DataFrame, at: str | None = None) -> DataFrame:
    """The chunks (``doc_id, chunk_id, text``) that have been embedded, once for each embedded row. Of a
    chunk_id that stands on several rows the last counts, by ``at`` (without one, the largest doc_id)."""
    one = chunks.where("chunk_id IS NOT NULL").groupBy("chunk_id").agg(F.max_by(F.struct("doc_id", "text"), F.struct(F.col(at) if at else F.col("doc_id"), "doc_id")).alias("c"))
    return embedded.select("chunk_id").join(one, "chunk_id").select("c.doc_id", "chunk_id", F.coalesce("c.text", F.lit("")).alias("text"))


def links(entities: DataFrame) -> DataFrame:
    """HAS_LINK from each organisation to the first URL after it in its chunk."""
    o = entities.where("type = 'ORG'").select("doc_id", "chunk_id", F.col("id").alias("head_ent_id"), F.col("end").alias("o_end"), "source_sha1")
    u = entities.where("type = 'URL'").select("doc_id", "chunk_id", F.col("id").alias("u_id"), F.col("start").alias("u_start"), F.col("end").alias("u_end"))
    near = o.join(u, ["doc_id", "chunk_id"]).where("u_start > o_end").groupBy("doc_id", "chunk_id", "head_ent_id", "source_sha1").agg(F.min_by("u_id", F.struct("u_start", "u_end", "u_id")).alias("tail_ent_id"))
    return near.select(short_sha1(F.col("doc_id"), F.col("chunk_id"), F.col("head_ent_id"), F.col("tail_ent_id"), F.lit("HAS_LINK")).alias("id"), "head_ent_id", "tail_ent_id", F.lit("HAS_LINK").alias("type"), F.lit(0.6).alias("conf"), "chunk_id", "doc_id", "source_sha1")


def features(mentions: DataFrame) -> DataFrame:
    """Adds ``form, is_pronoun, number, gender, device`` to ``doc_id, chunk_id, type, text, start, end, sent_no``."""
    low = F.lower(strip(F.col("text")))
    table = lambda i: F.coalesce(*[F.when(low == p, F.lit(v[i])) for p, v in PRONOUNS.items()])
    estimate = F.when(F.col("type") == "ORG", "singular").when(low.isin("they", "these", "those"), "plural").when((F.length(low) > 3) & low.endswith("s"), "plural").otherwise("singular")
    by_name = F.when(F.col("type") != "PERSON", "unknown").when(low.isin(FEM), "fem").when(low.isin(MASC), "masc").otherwise("unknown")
    device = F.col("type").isin("PRODUCT", "DEVICE") | low.rlike("|".join(DEVICE_WORDS))
    return mentions.withColumns({"form": F.when(low.isin(list(PRONOUNS)), low), "is_pronoun": low.isin(list(PRONOUNS)), "number": F.coalesce(table(0), estimate), "estimate": estimate, "gender": F.coalesce(table(1), by_name), "device": device})


def resolve(mentions: DataFrame, window_sentences: int = 3, most: int = 30) -> DataFrame:
    """Antecedents: each pronoun meets the ``most`` nearest earlier mentions within ``window_sentences``.

    ``mentions`` has ``doc_id, mention_id, type, text, start, end, sent_no, n`` (``n`` its place in the
    document). The meeting is an equi-join on document and block of places, never a whole document
    against itself: a pronoun at place n sees blocks n // most and the one before."""
    f = features(mentions).withColumn("block", F.floor(F.col("n") / most))
    p = f.where("is_pronoun")
    p2 = p.select("doc_id", "mention_id", "n", "sent_no", "form", "number", "gender", F.explode(F.array("block", F.col("block") - 1)).alias("block"))
    c = f.select("doc_id", "block", F.col("n").alias("cn"), F.col("sent_no").alias("cs"), F.col("mention_id").alias("cid"), F.col("estimate").alias("c_number"), F.col("gender").alias("c_gender"), F.col("device").alias("c_device"), F.col("is_pronoun").alias("c_pronoun"))
    near = p2.join(c, ["doc_id", "block"]).where((F.col("cn") < F.col("n")) & (F.abs(F.col("sent_no") - F.col("cs")) <= window_sentences) & (F.col("n") - F.col("cn") <= most))
    he, she = F.col("form").isin("he", "him"), F.col("form").isin("she", "her")
    fits = F.when(he & ~F.col("c_gender").isin("masc", "unknown"), False).when(she & ~F.col("c_gender").isin("fem", "unknown"), False).otherwise(F.col("c_number") == F.col("number"))
    near = near.where(fits)
    it = F.col("form").isin("it", "this", "that")
    best = near.groupBy("doc_id", "mention_id").agg(F.min_by(F.struct("cid", "c_device"), F.struct(F.when(it & F.col("c_device"), 0).otherwise(1), -F.col("cn"))).alias("b"))
    out = p.join(best, ["doc_id", "mention_id"], "left")
    rule = F.when(F.col("b").isNull(), "unresolved").when(it & F.col("b.c_device"), "prefer_device_over_org").otherwise("nearest_compatible")
    conf = F.when(F.col("b").isNull(), 0.0).when(it, F.when(F.col("b.c_device"), 0.85).otherwise(0.75)).when(F.col("number") == "singular", 0.75).otherwise(0.7)
    return out.select("doc_id", "mention_id", F.col("b.cid").alias("antecedent_mention_id"), rule.alias("coref_rule"), conf.alias("coref_conf"))


def chains(mentions: DataFrame, resolved: DataFrame, max_rounds: int = 40) -> DataFrame:
    """``doc_id, mention_id, chain_id``: pointer doubling over the antecedents, singletons included.

    Every antecedent is earlier, so the pointers form a forest; each round halves its depth."""
    from seamark.functions.dist import cut

    up = mentions.select("doc_id", "mention_id").join(resolved.select("doc_id", "mention_id", "antecedent_mention_id"), ["doc_id", "mention_id"], "left")
    up = cut(up.select("doc_id", "mention_id", F.coalesce("antecedent_mention_id", "mention_id").alias("root")))
    for _ in range(max_rounds):
        hop = up.select("doc_id", F.col("mention_id").alias("root"), F.col("root").alias("next"))
        new = cut(up.join(hop, ["doc_id", "root"], "left").select("doc_id", "mention_id", F.coalesce("next", "root").alias("root"), (F.coalesce("next", "root") != F.col("root")).alias("moved")))
        moved = new.where("moved").limit(1).count()
        up = new.drop("moved")
        if not moved:
            break
    return up.select("doc_id", "mention_id", F.col("root").alias("chain_id"))


def numbered(entities: DataFrame) -> DataFrame:
    """Entities with their chunk's ``ord`` as mentions: ``mention_id`` and ``n``, their place in the document.

    Entities carry no sentence, so ``sent_no`` is constant and only the number of mentions bounds the look-back."""
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("ord", "start", "end", "type"))
    return entities.withColumns({"mention_id": F.concat_ws(":", "doc_id", "chunk_id", F.concat_ws("-", "start", "end"), "type"), "n": place, "sent_no": F.lit(0)})
