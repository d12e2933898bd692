"""Extracted slide and page elements: chunks by title, page text, picture boxes, scan and money signals."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seamark.functions.text import WS, strip

PARAGRAPH = "\ue001"

# Words that tell a financial page.
MONEY_WORDS = ["funding", "cost share", "fiscal year", "fy2", "budget", "milestones"]


def usable(elements: DataFrame) -> DataFrame:
    return elements.where("element_id IS NOT NULL").dropDuplicates(["element_id"])


def title_sections(elements: DataFrame, combine_under: int = 500, most: int = 1500) -> DataFrame:
    """``filename, page, chunk, text, n_chars``: texts of a page gathered in order, a line end between them.

    A text over ``most`` characters is split at that length. A chunk is closed before a text that would
    take it beyond ``most``, and before a title once it holds ``combine_under`` characters, so small
    sections are combined. Chunks stay within a page of a file: a file that holds a large share of all
    rows is still spread over its pages. The accumulator keeps only the places where chunks start."""
    e = usable(elements).where(F.length(strip(F.col("text"))) > 0).select("filename", F.coalesce("metadata.page_number", F.lit(0)).alias("page"), "ord", "element_id", "type", "text")
    pieces = F.transform(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / most).cast("int")), lambda i: F.substring(F.col("text"), i * most + 1, F.lit(most)))
    e = e.select("filename", "page", "ord", "element_id", "type", F.posexplode(pieces).alias("part", "text"))
    title = (F.coalesce("type", F.lit("")) == "Title") & (F.col("part") == 0)
    row = F.struct("ord", "element_id", "part", "text", F.length("text").alias("n"), title.alias("title"))
    pages = e.groupBy("filename", "page").agg(F.array_sort(F.collect_list(row)).alias("s"))
    zero = F.struct(F.lit(0).alias("i"), F.lit(0).alias("cur"), F.expr("array(0)").alias("starts"))

    def step(acc, s):
        flush = (acc["i"] > 0) & ((acc["cur"] + 1 + s["n"] > most) | (s["title"] & (acc["cur"] >= combine_under)))
        begun = F.when(acc["i"] == 0, s["n"]).otherwise(acc["cur"] + 1 + s["n"])
        return F.struct((acc["i"] + 1).alias("i"), F.when(flush, s["n"]).otherwise(begun).alias("cur"), F.when(flush, F.concat(acc["starts"], F.array(acc["i"]))).otherwise(acc["starts"]).alias("starts"))

    pages = pages.withColumn("starts", F.aggregate("s", zero, step, lambda acc: acc["starts"]))
    each = pages.select("filename", "page", "s", "starts", F.posexplode("starts").alias("chunk", "at"))
    end = F.coalesce(F.get("starts", F.col("chunk") + 1), F.size("s"))
    text = F.array_join(F.transform(F.slice("s", F.col("at") + 1, end - F.col("at")), lambda x: x["text"]), "\n")
    return each.select("filename", "page", "chunk", text.alias("text")).withColumn("n_chars", F.length("text"))


def asset_chunks(assets: DataFrame) -> DataFrame:
    """``doc_id, name, text, metadata`` of tables and images (``doc_id, path, type, content``).

    A table's text is its content, an image's (or a table's without content) its name in brackets."""
    name = F.regexp_extract("path", r"([^/\\\\]*)$", 1)
    text = F.when((F.col("type") == "table") & F.col("content").isNotNull(), F.concat(F.lit("Table Data:\n"), "content")).otherwise(F.concat(F.lit("["), F.upper("type"), F.lit(": "), name, F.lit("]")))
    meta = F.struct(name.alias("filename"), F.col("path").alias("file_path"), "type", asset_page(name).alias("page_number"))
    return assets.select("doc_id", name.alias("name"), text.alias("text"), meta.alias("metadata"))


def with_assets(sections: DataFrame, assets: DataFrame) -> DataFrame:
    """``doc_id, chunk_id, text, metadata``: the text chunks of a document, then its tables, then its images,
    numbered from 0."""
    meta = F.struct(F.col("filename"), F.lit(None).cast("string").alias("file_path"), F.lit("text").alias("type"), F.nullif(F.col("page"), F.lit(0)).alias("page_number"))
    texts = sections.select(F.col("filename").alias("doc_id"), F.lit(0).alias("a"), "page", "chunk", F.lit("").alias("name"), "text", meta.alias("metadata"))
    kind = F.when(F.col("metadata.type") == "table", 1).otherwise(2)
    more = asset_chunks(assets).select("doc_id", kind.alias("a"), F.lit(0).alias("page"), F.lit(0).alias("chunk"), "name", "text", "metadata")
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("a", "page", "chunk", "name")) - 1
    return texts.unionByName(more).withColumn("chunk_id", place).select("doc_id", "chunk_id", "text", "metadata")


def page_markdown(elements: DataFrame) -> DataFrame:
    """``filename, page, markdown``: titles as headings, list items as bullets, tables as a marker."""
    e = usable(elements).where("text IS NOT NULL").select("filename", F.coalesce("metadata.page_number", F.lit(0)).alias("page"), "ord", "element_id", "type", "text")
    md = F.when(F.col("type") == "Title", F.concat(F.lit("## "), "text")).when(F.col("type") == "ListItem", F.concat(F.lit("- "), "text")).when(F.col("type") == "Table", F.concat(F.lit("[TABLE ON PAGE "), F.col("page"), F.lit("]"))).otherwise(F.col("text"))
    lines = F.array_sort(F.collect_list(F.struct("ord", "element_id", md.alias("md"))))
    return e.groupBy("filename", "page").agg(F.array_join(F.transform(lines, lambda x: x["md"]), "\n").alias("markdown"))


def boxes(docs: DataFrame, least: float = 150.0, pad: float = 20.0, width: float = 612.0, height: float = 792.0) -> DataFrame:
    """``doc_id, page, sha1, x0, y0, x1, y1``: pictures of at least ``least`` on both sides, padded, clamped to the page."""
    i = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).select("doc_id", F.explode("images").alias("i")).where("size(i.bbox) = 4")
    b = [F.col("i.bbox")[k] for k in range(4)]
    i = i.where(((b[2] - b[0]) >= least) & ((b[3] - b[1]) >= least))
    return i.select("doc_id", F.col("i.page").alias("page"), F.col("i.sha1").alias("sha1"), F.greatest(b[0] - pad, F.lit(0.0)).alias("x0"), F.greatest(b[1] - pad, F.lit(0.0)).alias("y0"), F.least(b[2] + pad, F.lit(width)).alias("x1"), F.least(b[3] + pad, F.lit(height)).alias("y1"))


def raw_boxes(docs: DataFrame) -> DataFrame:
    """``doc_id, page, ord, x0, y0, x1, y1`` of every picture that has four coordinates, in the document's order."""
    i = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).select("doc_id", F.posexplode("images").alias("ord", "i")).where("size(i.bbox) = 4")
    return i.select("doc_id", F.col("i.page").alias("page"), "ord", *[F.col("i.bbox")[k].alias(c) for k, c in enumerate(("x0", "y0", "x1", "y1"))])


def merge_boxes(rows: DataFrame, gap: float = 50.0) -> DataFrame:
    """``doc_id, page, x0, y0, x1, y1``: boxes of a page grown together while within ``gap`` on both axes.

    A box takes in all that are near until none is left; a finished one is not looked at again. Boxes go in
    the order ``ord``, where that is given, else from left to right. Growing is sequential; the boxes of one
    page (a handful) are one group."""
    from seamark.functions.dist import map_groups

    ordered = "ord" in rows.columns

    def merge(t: pa.Table):
        boxes = list(zip(*(t.column(c).to_pylist() for c in ("x0", "y0", "x1", "y1")), strict=True))
        boxes = [b for _, b in sorted(zip(t.column("ord").to_pylist(), boxes, strict=True))] if ordered else sorted(boxes)
        out = []
        while boxes:
            (x0, y0, x1, y1), *boxes = boxes
            grown = True
            while grown:
                near = [b for b in boxes if x0 <= b[2] + gap and b[0] <= x1 + gap and y0 <= b[3] + gap and b[1] <= y1 + gap]
                if grown := bool(near):
                    # One at a time: each box taken in may bring the next one near.
                    b = near[0]
                    boxes.remove(b)
                    x0, y0, x1, y1 = min(x0, b[0]), min(y0, b[1]), max(x1, b[2]), max(y1, b[3])
            out.append((x0, y0, x1, y1))
        head = {"doc_id": t.column("doc_id").to_pylist()[:1] * len(out), "page": t.column("page").to_pylist()[:1] * len(out)}
        return head | {c: [o[i] for o in out] for i, c in enumerate(("x0", "y0", "x1", "y1"))}

    cols = ["doc_id", "page", *(["ord"] if ordered else []), "x0", "y0", "x1", "y1"]
    return map_groups(rows.where("page IS NOT NULL").select(*cols), ["doc_id", "page"], merge, "doc_id string, page int, x0 double, y0 double, x1 double, y1 double")


def snap_to_headers(rows: DataFrame, texts: DataFrame, within: float = 200.0) -> DataFrame:
    """Boxes whose top is raised to the highest text of the page (``texts``: ``doc_id, page, y0, y1``) that ends
    above them, less than ``within`` away; whatever its place from left to right."""
    t = texts.select(F.col("doc_id"), F.col("page"), F.col("y0").alias("t0"), F.col("y1").alias("t1"))
    key = ["doc_id", "page", "x0", "y0", "x1", "y1"]
    near = rows.join(t, ["doc_id", "page"]).where((F.col("t1") < F.col("y0")) & (F.col("y0") - F.col("t1") < within) & (F.col("t0") < F.col("y0")))
    best = near.groupBy(*key).agg(F.min("t0").alias("top"))
    return rows.join(best, key, "left").withColumn("y0", F.coalesce("top", "y0")).drop("top")


def figures(docs: DataFrame, texts: DataFrame | None = None, least: float = 150.0, pad: float = 20.0, width: float = 612.0, height: float = 792.0) -> DataFrame:
    """``doc_id, page, x0, y0, x1, y1``: pictures merged, those of at least ``least`` on both sides snapped to
    headers above them, padded, and clamped to the page."""
    m = merge_boxes(raw_boxes(docs)).where((F.col("x1") - F.col("x0") >= least) & (F.col("y1") - F.col("y0") >= least))
    m = m if texts is None else snap_to_headers(m, texts)
    return m.select("doc_id", "page", F.greatest(F.col("x0") - pad, F.lit(0.0)).alias("x0"), F.greatest(F.col("y0") - pad, F.lit(0.0)).alias("y0"), F.least(F.col("x1") + pad, F.lit(width)).alias("x1"), F.least(F.col("y1") + pad, F.lit(height)).alias("y1"))


def signals(docs: DataFrame) -> DataFrame:
    """``doc_id, page, is_scan, keyword_hits, dollars, is_financial`` of each page."""
    p = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).select("doc_id", F.posexplode(F.transform(F.coalesce("pages", F.array("text")), lambda x: F.coalesce(x, F.lit("")))).alias("k", "body"))
    low = F.lower("body")
    hits = sum((F.when(low.contains(w), 1).otherwise(0) for w in MONEY_WORDS), F.lit(0))
    dollars = F.length("body") - F.length(F.replace("body", F.lit("$"), F.lit("")))
    out = p.select("doc_id", (F.col("k") + 1).alias("page"), (F.length(strip(F.col("body"))) < 50).alias("is_scan"), hits.alias("keyword_hits"), dollars.alias("dollars"))
    return out.withColumn("is_financial", (F.col("keyword_hits") >= 2) | (F.col("dollars") >= 3))


def clean_scan_text(c):
    """Compatibility forms resolved, line ends as LF, words closed over line-end hyphens, paragraphs kept, other
    white space as one blank. The normal form is taken in Arrow batches."""

    @F.pandas_udf("string")
    def nfkc(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))

    x = nfkc(c)
    x = F.regexp_replace(x, r"\r\n?", "\n")
    x = F.regexp_replace(x, r"(?U)([^\s\x1c-\x1f])-[\s\x1c-\x1f]*\n[\s\x1c-\x1f]*([^\s\x1c-\x1f])", "$1$2")
    x = F.regexp_replace(x, r"\n\n+", PARAGRAPH)
    x = F.regexp_replace(x, rf"(?U){WS}+", " ")
    return strip(F.regexp_replace(x, PARAGRAPH, "\n\n"))


def lemmas(texts: DataFrame, make_nlp, labels: tuple[str, ...] = ("PERSON", "GPE", "LOC", "ORG", "PRODUCT", "FAC"), stop_words: bool = False, keep_case: bool = False) -> DataFrame:
    """``texts`` (``text`` and others) with ``processed_text`` and ``entities``: words in lower case and base form,
    without punctuation and (unless ``stop_words``) stop words; words of entities with these labels stay whole,
    with ``keep_case`` as written.

    ``make_nlp`` makes, once in each worker, what turns a text into tokens and entities (the interface of
    spaCy's pipelines, which are not part of this repository)."""
    kind = "struct<processed_text:string,entities:array<struct<text:string,label:string,start:int,end:int>>>"

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        nlp = make_nlp()
        for series in batches:
            rows = []
            for text in series.tolist():
                doc = nlp(text or "")
                ents = [e for e in doc.ents if e.label_ in labels]
                inside = {i for e in ents for i in range(e.start, e.end)}
                words = []
                for i, t in enumerate(doc):
                    if t.is_space or t.is_punct or (t.is_stop and not stop_words and i not in inside):
                        continue
                    words.append((t.text if keep_case else t.text.lower()) if i in inside else t.lemma_.lower())
                rows.append({"processed_text": " ".join(words), "entities": [{"text": e.text, "label": e.label_, "start": e.start_char, "end": e.end_char} for e in ents]})
            yield pd.DataFrame(rows, columns=["processed_text", "entities"])

    return texts.withColumn("__p", run(clean_scan_text(F.coalesce("text", F.lit(""))))).select(*texts.columns, "__p.processed_text", "__p.entities")


def asset_page(name):
    """The page number in an asset's file name, such as table_pg12_3.csv."""
    return F.regexp_extract(name, r"(?:^|_)pg(\d+)(?:_|\.[^.]*$|$)", 1).try_cast("int")
