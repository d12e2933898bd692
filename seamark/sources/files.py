"""Sources and sinks: extracted JSON, JSON lines, contracts, caches of external ids, raw files, streams."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seamark.functions.text import or_else
from seamark.operators.contract import load as load_contract

IMAGE = "array<struct<sha1:string,page:int,bbox:array<double>,saved_path:string,ocr_text:string>>"
EXTRACTED = f"doc_id string, source_path string, path string, file string, pages array<string>, text string, images {IMAGE}"


def extracted_json(spark: SparkSession, path: str) -> DataFrame:
    """Files of one object or an array of objects; ``item`` counts the objects of a file from 1."""
    raw = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json").select(F.input_file_name().alias("from_file"), F.trim("value").alias("v"))
    as_array = F.when(F.col("v").startswith("["), F.col("v")).otherwise(F.concat(F.lit("["), "v", F.lit("]")))
    rows = raw.select("from_file", F.posexplode(F.from_json(as_array, f"array<struct<{','.join(':'.join(c.strip().split(' ', 1)) for c in _columns(EXTRACTED))}>>")).alias("k", "r"))
    path_of = or_else(F.col("r.source_path"), or_else(F.col("r.path"), F.coalesce("r.file", F.lit(""))))
    return rows.select("from_file", (F.col("k") + 1).alias("item"), "r.doc_id", path_of.alias("source_path"), "r.pages", "r.text", "r.images")


def _columns(ddl: str) -> list[str]:
    out, depth = [""], 0
    for c in ddl:
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            out.append("")
        else:
            out[-1] += c
    return out


def safe_name(path, item):
    """A file's base name without extension and odd characters, with its item number after the first."""
    base = F.regexp_replace(F.regexp_extract(path, r"([^/\\]*)$", 1), r"\.[^.]*$", "")
    base = or_else(F.regexp_replace(base, r"[^\p{L}\p{N}_-]", ""), F.lit("doc"))
    return F.when(item > 1, F.concat(base, F.lit("."), item)).otherwise(base)


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def python_json(row):
    """``row`` (a struct) as JSON text with sorted keys, ", " and ": " between, characters as they are."""

    @F.pandas_udf("string")
    def spaced(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else json.dumps(json.loads(t), ensure_ascii=False, sort_keys=True))

    return spaced(F.to_json(row, {"ignoreNullFields": "false"}))


def write_json_lines(df: DataFrame, path: str, ordered: bool = True, spaced: bool = False, by: str | None = None) -> None:
    """Rows as JSON lines. ``ordered`` sorts them by their text, in parallel, one range to a file; ``by`` sorts
    by a column that is not written instead. ``spaced`` writes blanks after separators, as Python does."""
    row = F.struct(*sorted(c for c in df.columns if c != by))
    lines = df.select(python_json(row).alias("value") if spaced else F.to_json(row).alias("value"), *([by] if by else []))
    if by or ordered:
        lines = lines.orderBy(by or "value")
    lines.select("value").write.mode("overwrite").text(path)


def lines_text(spark: SparkSession, path: str) -> Iterator[str]:
    """The lines of a folder of text files in the order they were written, one partition at a time."""
    rows = spark.read.text(path).select("value", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i")).orderBy("f", "i")
    return (r.value for r in rows.toLocalIterator())


def entity_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of the files ``*.entities.jsonl`` of a folder, with ``doc_base``, the name before that."""
    rows = spark.read.schema(schema).option("pathGlobFilter", "*.entities.jsonl").json(path)
    return rows.withColumn("doc_base", F.regexp_extract(F.input_file_name(), r"([^/]*?)(?:\.entities)?\.entities\.jsonl$", 1))


def contract(path: str) -> dict:
    """A contract file, for ``operators.contract.rules``."""
    return load_contract(path)


def id_cache(spark: SparkSession, path: str) -> DataFrame:
    """``key, id, pos`` of a JSON map from names to an id or a list of entries (the first non-empty id counts);
    ``pos`` is the key's place in the file."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,string>").alias("m"))
    raw = raw.select(F.posexplode(F.map_entries("m")).alias("pos", "e")).select("pos", "e.key", F.col("e.value").alias("v"))
    listed = F.from_json("v", "array<struct<id:string>>")
    first = F.element_at(F.filter(F.transform(listed, lambda x: F.trim(x["id"])), lambda x: F.coalesce(x, F.lit("")) != ""), 1)
    return raw.select("key", F.when(F.col("v").startswith("["), F.when(F.size(listed) > 0, first)).otherwise(F.col("v")).alias("id"), "pos").where("coalesce(id, '') <> ''")


def clean_name(name):
    """A file's name with the characters that file systems reserve as '_'."""
    return F.regexp_replace(name, r'[<>:"/\\\\|?*]', "_")


def raw_files(spark: SparkSession, path: str, pattern: str = "*.{pdf,docx,pptx,html,md,adoc,txt,png,jpg}") -> DataFrame:
    """``path, content`` of documents below a folder, unreadable ones left out."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).option("ignoreCorruptFiles", True).load(path).select("path", "content")


def extract_pages(raw: DataFrame, extractors: dict[str, Callable[[bytes], list[str]]] | None = None) -> DataFrame:
    """``source_path, pages, text, error`` of raw files.

    HTML, Markdown, AsciiDoc and plain text are read here; ``extractors`` (suffix to a function from content to
    pages) reads other formats, such as PDF or slides by a converter that is installed. A file nothing can read has
    null pages and text; one whose extractor fails has its message under ``error``."""
    suffix = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    plain = F.decode("content", "UTF-8")
    r = raw.select(F.col("path").alias("source_path"), suffix.alias("suffix"), "content", F.when(suffix.isin("html", "htm"), html_text(plain)).when(suffix.isin("md", "adoc", "txt"), plain).alias("text"))
    made = extractors or {}

    def run(batches):
        for b in batches:
            pages, errors = [], []
            for s, c in zip(b.column("suffix").to_pylist(), b.column("content").to_pylist(), strict=True):
                try:
                    pages.append(made[s](c) if s in made else None)
                    errors.append(None)
                except Exception as e:
                    pages.append(None)
                    errors.append(str(e))
            yield pa.RecordBatch.from_arrays([b.column("source_path"), pa.array(pages, pa.list_(pa.string())), b.column("text"), pa.array(errors, pa.string())], names=["source_path", "pages", "text", "error"])

    if not made:
        return r.select("source_path", F.lit(None).cast("array<string>").alias("pages"), "text", F.lit(None).cast("string").alias("error"))
    return r.mapInArrow(run, "source_path string, pages array<string>, text string, error string")


def html_text(c):
    """The text of an HTML page: scripts, tags and the commonest entities resolved."""
    x = F.regexp_replace(c, r"(?is)<(script|style)\b.*?</\1>", " ")
    x = F.regexp_replace(F.regexp_replace(x, r"(?i)<(br|/p|/div|/li|/h\d)\b[^>]*>", "\n"), r"<[^>]+>", " ")
    for name, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        x = F.replace(x, F.lit(name), F.lit(sign))
    return x


# Parts of names of fields that hold text.
TEXT_FIELDS = ["text", "content", "body", "paragraph", "doc", "ocr"]


def text_paths(spark: SparkSession, path: str, peek: int = 5) -> DataFrame:
    """``from_file, at, n``: where the JSON files of a folder hold texts, and how long these are.

    Fields whose name tells a text, and texts directly in lists, of which the first ``peek`` entries are looked at."""

    def walk(x, at: str, out: list):
        if isinstance(x, dict):
            for k, v in x.items():
                if isinstance(v, str) and v.strip() and any(t in k.lower() for t in TEXT_FIELDS):
                    out.append((f"{at}.{k}", len(v)))
                elif isinstance(v, (dict, list)):
                    walk(v, f"{at}.{k}", out)
        elif isinstance(x, list):
            for i, v in enumerate(x[:peek]):
                if isinstance(v, str) and v.strip():
                    out.append((f"{at}[{i}]", len(v)))
                elif isinstance(v, (dict, list)):
                    walk(v, f"{at}[{i}]", out)
        return out

    def run(batches):
        for b in batches:
            rows = [(f, *hit) for f, v in zip(b.column("from_file").to_pylist(), b.column("value").to_pylist(), strict=True) for hit in walk(json.loads(v), "$", [])]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.int32()))], names=["from_file", "at", "n"])

    raw = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json").select(F.input_file_name().alias("from_file"), "value")
    return raw.mapInArrow(run, "from_file string, at string, n int")
