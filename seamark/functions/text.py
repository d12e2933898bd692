"""Text and identifier expressions that stay on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space, as str.split() and str.strip() see it.
WS = r"[\s\x1c-\x1f]"
MARK = ""
# Fixed value: a stop with its closing marks, or a run of line ends, closes a sentence.
BOUNDARY = r"([.!?][\"'”’)\]]*|\n\n+)"


def short_sha1(*parts: Column | str) -> Column:
    """The first 16 hex digits of the SHA-1 of the parts joined with '|'."""
    return F.substring(F.sha1(F.concat_ws("|", *[F.col(p) if isinstance(p, str) else p for p in parts])), 1, 16)


def strip(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, rf"(?U)^{WS}+", ""), rf"(?U){WS}+$", "")


def tokens(c: Column) -> Column:
    """White-space tokens; an empty array for a blank text."""
    return F.filter(F.split(c, rf"(?U){WS}+"), lambda t: t != "")


def or_else(a: Column, b: Column) -> Column:
    """``a`` unless it is null or empty, as Python's ``or``."""
    return F.coalesce(F.nullif(a, F.lit("")), b)


def spans(c: Column) -> Column:
    """``array<struct<a,b>>``: sentence spans, trimmed, in code points; empty pieces dropped."""
    pieces = F.split(F.regexp_replace(c, BOUNDARY, "$1" + MARK), MARK)
    lead = lambda p: F.length(p) - F.length(F.regexp_replace(p, rf"(?U)^{WS}+", ""))
    core = lambda p: F.length(strip(p))
    measured = F.transform(pieces, lambda p: F.struct(F.length(p).alias("n"), lead(p).alias("lead"), core(p).alias("core")))
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<a:int,b:int>>)").alias("out"))

    def step(acc, m):
        a = acc["at"] + m["lead"]
        here = F.array(F.struct(a.alias("a"), (a + m["core"]).alias("b")))
        return F.struct((acc["at"] + m["n"]).alias("at"), F.when(m["core"] > 0, F.concat(acc["out"], here)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(measured, start, step, lambda acc: acc["out"])


def matches(c: Column, pattern: str) -> Column:
    """``array<struct<text,a>>``: non-overlapping matches of ``pattern`` and where they start, in code points."""
    hits = F.regexp_extract_all(c, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(c, pattern, -1), lambda g: F.length(g))
    zipped = F.zip_with(hits, F.slice(gaps, 1, F.size(hits)), lambda h, g: F.struct(h.alias("h"), g.alias("g")))
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<text:string,a:int>>)").alias("out"))

    def step(acc, m):
        a = acc["at"] + m["g"]
        return F.struct((a + F.length(m["h"])).alias("at"), F.concat(acc["out"], F.array(F.struct(m["h"].alias("text"), a.alias("a")))).alias("out"))

    return F.when(F.size(hits) == 0, F.expr("cast(array() as array<struct<text:string,a:int>>)")).otherwise(F.aggregate(zipped, start, step, lambda acc: acc["out"]))


def uuid5_url(name: Column) -> Column:
    """UUID version 5 of ``name`` in the URL namespace."""
    h = F.sha1(F.concat(F.unhex(F.lit("6ba7b8119dad11d180b400c04fd430c8")), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex((F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3)).bitwiseOR(8)))
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))
