"""Extracted documents to sentences, chunks and checks of both."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seamark.functions.text import or_else, short_sha1, spans, tokens

MAX_TOKENS = 512


def coerce(raw: DataFrame) -> DataFrame:
    """``doc_id, source_path, pages``: a repeated id counts once, ``text`` stands in for missing pages,
    a null page is '', a missing id is a hash of path and pages."""
    pages = F.transform(F.coalesce("pages", F.array("text")), lambda p: F.coalesce(p, F.lit("")))
    made = raw.select("doc_id", F.coalesce("source_path", F.lit("")).alias("source_path"), pages.alias("pages"))
    made = made.withColumn("doc_id", or_else(F.col("doc_id"), F.sha1(F.concat_ws("|", "source_path", F.array_join("pages", "")))))
    return made.dropDuplicates(["doc_id"])


def sentences(docs: DataFrame) -> DataFrame:
    """``doc_id, sent_id, page, ord, char_start, char_end, text`` in the order of the document."""
    paged = docs.select("doc_id", F.posexplode("pages").alias("p", "body"))
    cut = paged.select("doc_id", (F.col("p") + 1).alias("page"), "body", F.posexplode(spans(F.col("body"))).alias("ord", "s"))
    a, b = F.col("s.a"), F.col("s.b")
    return cut.select("doc_id", short_sha1("doc_id", "page", a, b).alias("sent_id"), "page", "ord", a.alias("char_start"), b.alias("char_end"), F.substring("body", a + 1, b - a).alias("text"))


def chunks(sents: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Greedy packing of a document's sentences: ``doc_id, chunk_id, ord, text, sentence_ids, page_start,
    page_end, n_tokens``. A sentence over the budget is a chunk of its own.

    The accumulator keeps only the places where chunks start, so its size is that of the result."""
    row = F.struct("page", "ord", "sent_id", "text", F.size(tokens(F.col("text"))).alias("n"))
    docs = sents.groupBy("doc_id").agg(F.array_sort(F.collect_list(row)).alias("s"))
    zero = F.struct(F.lit(0).alias("i"), F.lit(0).alias("cur"), F.expr("array(0)").alias("starts"))

    def step(acc, s):
        flush = (acc["i"] > 0) & (acc["cur"] + s["n"] > max_tokens) & (acc["cur"] > 0)
        return F.struct((acc["i"] + 1).alias("i"), F.when(flush, s["n"]).otherwise(acc["cur"] + s["n"]).alias("cur"), F.when(flush, F.concat(acc["starts"], F.array(acc["i"]))).otherwise(acc["starts"]).alias("starts"))

    docs = docs.withColumn("starts", F.aggregate("s", zero, step, lambda acc: acc["starts"]))
    each = docs.select("doc_id", "s", "starts", F.posexplode("starts").alias("ord", "at"))
    end = F.coalesce(F.get("starts", F.col("ord") + 1), F.size("s"))
    each = each.select("doc_id", "ord", F.slice("s", F.col("at") + 1, end - F.col("at")).alias("part"))
    ids = F.transform("part", lambda x: x["sent_id"])
    pages = F.transform("part", lambda x: x["page"])
    return each.select(
        "doc_id",
        short_sha1(F.col("doc_id"), F.element_at(ids, 1), F.element_at(ids, -1)).alias("chunk_id"),
        "ord",
        F.array_join(F.transform("part", lambda x: x["text"]), " ").alias("text"),
        ids.alias("sentence_ids"),
        F.array_min(pages).alias("page_start"),
        F.array_max(pages).alias("page_end"),
        F.aggregate(F.transform("part", lambda x: x["n"]), F.lit(0), lambda a, x: a + x).alias("n_tokens"),
    )


def fixed_windows(docs: DataFrame, size: int = 1200, overlap: int = 200) -> DataFrame:
    """``doc_id, start, text``: windows of ``size`` characters, each ``size - overlap`` after the last."""
    step = size - overlap
    starts = F.sequence(F.lit(0), F.length("text") - 1, F.lit(step))
    return docs.where("text IS NOT NULL AND text <> ''").select("doc_id", "text", F.explode(starts).alias("start")).select("doc_id", "start", F.substring("text", F.col("start") + 1, F.lit(size)).alias("text"))


def summary(docs: DataFrame, sents: DataFrame, chunk_rows: DataFrame) -> DataFrame:
    """``doc_id, doc_sha1, num_pages, n_sentences, n_chunks`` of each document."""
    n_s = sents.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_sentences"))
    n_c = chunk_rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_chunks"))
    base = docs.select("doc_id", F.sha1(F.array_join("pages", "")).alias("doc_sha1"), F.size("pages").alias("num_pages"))
    return base.join(n_s, "doc_id", "left").join(n_c, "doc_id", "left").fillna(0, ["n_sentences", "n_chunks"])


# What a normalized document says of the program that made it.
MADE_BY = {"name": "seamark.normalize", "version": "0.2.0", "spec": "v1"}


def normalized(docs: DataFrame, sents: DataFrame, chunk_rows: DataFrame) -> DataFrame:
    """``doc_id`` and one nested row for each document: ``meta, doc, sentences, chunks, images``.

    ``docs`` has ``doc_id, source_path, pages`` and perhaps ``images``. The parts of a document are gathered, so
    this is the form of the sink; other operators read the flat tables."""
    one = F.struct("page", "ord", "doc_id", "sent_id", "text", "char_start", "char_end")
    ss = sents.groupBy("doc_id").agg(F.array_sort(F.collect_list(one)).alias("s"))
    ss = ss.select("doc_id", F.transform("s", lambda x: F.struct(*[x[c].alias(c) for c in ("doc_id", "sent_id", "page", "text", "char_start", "char_end")])).alias("sentences"))
    two = F.struct("ord", "doc_id", "chunk_id", "text", "sentence_ids", "page_start", "page_end")
    cs = chunk_rows.groupBy("doc_id").agg(F.array_sort(F.collect_list(two)).alias("c"))
    cs = cs.select("doc_id", F.transform("c", lambda x: F.struct(*[x[c].alias(c) for c in ("doc_id", "chunk_id", "text", "sentence_ids", "page_start", "page_end")])).alias("chunks"))
    n = lambda c: F.greatest(F.size(c), F.lit(0))
    meta = F.struct(F.struct(*[F.lit(v).alias(k) for k, v in MADE_BY.items()]).alias("normalizer"), F.sha1(F.array_join("pages", "")).alias("doc_sha1"), n("sentences").alias("n_sentences"), n("chunks").alias("n_chunks"))
    doc = F.struct("doc_id", "source_path", F.size("pages").alias("num_pages"), "pages")
    none = lambda c, kind: F.coalesce(c, F.expr(f"cast(array() as {kind})"))
    whole = docs.join(ss, "doc_id", "left").join(cs, "doc_id", "left")
    images = none("images", dict(docs.dtypes)["images"]) if "images" in docs.columns else F.expr("cast(array() as array<string>)")
    return whole.select("doc_id", meta.alias("meta"), doc.alias("doc"), none("sentences", dict(ss.dtypes)["sentences"]).alias("sentences"), none("chunks", dict(cs.dtypes)["chunks"]).alias("chunks"), images.alias("images"))


def schema_violations(texts: DataFrame) -> DataFrame:
    """``name, rule``: what normalized documents (``name, value``, JSON texts) lack: keys, or lists where lists
    have to be. A text that is no object has the one rule ``unreadable``."""
    has = lambda at, k: F.array_contains(F.json_object_keys(at), k)
    doc = F.get_json_object("value", "$.doc")
    no_list = lambda at: F.coalesce(~F.get_json_object("value", at).startswith("["), F.lit(False))
    rules = [F.when(~has(F.col("value"), k), f"missing key: {k}") for k in ("meta", "doc", "sentences", "chunks", "images")]
    rules += [F.when(~F.coalesce(has(doc, k), F.lit(False)), f"doc missing: {k}") for k in ("doc_id", "source_path", "num_pages", "pages")]
    rules += [F.when(no_list(f"$.{k}"), f"{k} must be an array") for k in ("doc.pages", "sentences", "chunks", "images")]
    readable = F.json_object_keys("value").isNotNull()
    every = F.when(readable, F.array_compact(F.array(*rules))).otherwise(F.array(F.lit("unreadable")))
    return texts.select("name", F.explode(every).alias("rule"))


def violations(docs: DataFrame, sents: DataFrame, chunk_rows: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """``doc_id, rule, item``: sentences whose text is not the slice of their page, chunks over the budget,
    chunks that name unknown or non-consecutive sentences or another page range."""
    body = docs.select("doc_id", F.posexplode("pages").alias("p", "body")).select("doc_id", (F.col("p") + 1).alias("page"), "body")
    s = sents.select("doc_id", "sent_id", "page", "char_start", "char_end", "text").dropDuplicates()
    off = s.join(body, ["doc_id", "page"], "left").where(~F.col("text").eqNullSafe(F.substring("body", F.col("char_start") + 1, F.col("char_end") - F.col("char_start"))))
    over = chunk_rows.where((F.size(tokens(F.col("text"))) > max_tokens) & (F.size("sentence_ids") > 1))
    order = Window.partitionBy("doc_id").orderBy("page", "char_start", "sent_id")
    placed = s.select("doc_id", "sent_id", "page", F.row_number().over(order).alias("at"))
    named = chunk_rows.select("doc_id", "chunk_id", "page_start", "page_end", F.posexplode("sentence_ids").alias("k", "sent_id")).join(placed, ["doc_id", "sent_id"], "left")
    per = named.groupBy("doc_id", "chunk_id", "page_start", "page_end").agg(F.count_if(F.col("at").isNull()).alias("lost"), F.count_distinct(F.col("at") - F.col("k")).alias("runs"), F.min("page").alias("lo"), F.max("page").alias("hi"))
    rule = lambda df, name, item: df.select("doc_id", F.lit(name).alias("rule"), F.col(item).alias("item"))
    out = rule(off, "slice_mismatch", "sent_id").unionByName(rule(over, "over_budget", "chunk_id"))
    out = out.unionByName(rule(per.where("lost > 0"), "unknown_sentence", "chunk_id")).unionByName(rule(per.where("lost = 0 AND runs > 1"), "not_consecutive", "chunk_id"))
    return out.unionByName(rule(per.where("lost = 0 AND (lo <> page_start OR hi <> page_end)"), "page_range", "chunk_id"))
