"""One consistent form for text that looks the same on the page (problem 3).

Each Arrow partition is handed to an embedded DuckDB, which rewrites the text column with
``translate``, ``replace``, regular expressions and ``nfc_normalize``. What is unified: widths of
letters, digits and blanks, ligatures and other compatibility forms that keep their look,
composed against combining accents, characters without ink, and look-alike letters of Latin,
Greek, Cyrillic, Armenian, Coptic, Cherokee and Lisu. What stays different: letter case, accents, raised and lowered characters,
a missing blank, and emoji (a joiner inside an emoji sequence is part of its look).

Defined results: a null text stays null, an empty or blank one becomes ''. Repeated rows are
kept by ``unify`` and counted once by ``same_look_pairs``; other columns pass through untouched.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamark.functions.dist import cut, lookup_join

# Letters of two scripts that share one shape in common fonts.
CYRILLIC = "АВЕЅІЈКМНОРСТУХԚԜҮаеѕіјорсухһԁԛԝѵ"
CYRILLIC_AS = "ABESIJKMHOPCTYXQWYaesijopcyxhdqwv"
GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονϳ"
GREEK_AS = "ABEZHIKMNOPTYXovj"
ARMENIAN = "ՕՍօհոսց"
ARMENIAN_AS = "OUohnug"
COPTIC = "ⲀⲂⲈⲎⲒⲔⲘⲚⲞⲢⲤⲦⲨⲬⲟⲣⲥ"
COPTIC_AS = "ABEHIKMNOPCTYXopc"
CHEROKEE = "ᎠᎡᎢᎥᎪᎫᎬᎳᎷᎻᎽᏀᏃᏎᏏᏒᏔᏙᏚᏞᏟᏢᏦᏴ"
CHEROKEE_AS = "DRTiAJEWMHYGZ4bRWVSLCPKB"
LISU = "ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ"
LISU_AS = "BPDTGKJCZFNLSRVHWXYAEIOU"
OTHER = "ɡɑÐƉ‐‑ʼ∶ꓸ"
OTHER_AS = "gaĐĐ--’:."

# Compatibility forms whose usual expansion has another look.
OTHER_LOOK = set("№ſﬅ℀℁℅℆℡℻℠™")
KEPT_TAGS = {"<wide>", "<narrow>", "<compat>", "<noBreak>", "<small>", "<isolated>", "<initial>", "<medial>", "<final>", "<vertical>"}

ZWNJ, ZWJ = "‌", "‍"
HOLD_JOIN, HOLD_SPLIT = "", ""


def _look_alikes() -> dict[str, str]:
    pairs = dict(zip(CYRILLIC + GREEK + ARMENIAN + COPTIC + CHEROKEE + LISU + OTHER, CYRILLIC_AS + GREEK_AS + ARMENIAN_AS + COPTIC_AS + CHEROKEE_AS + LISU_AS + OTHER_AS, strict=True))
    for cp in [*range(0x370, 0x530), *range(0x1F00, 0x2000)]:  # letters with accents follow their base letter
        whole = unicodedata.normalize("NFD", chr(cp))
        if len(whole) > 1 and whole[0] in pairs:
            pairs[chr(cp)] = unicodedata.normalize("NFC", pairs[whole[0]] + whole[1:])
    return {k: v for k, v in pairs.items() if len(v) == 1}


def tables() -> tuple[dict[str, str], dict[str, str], str]:
    """Single-character rewrites, many-character rewrites, and the characters without ink, by rule."""
    one, many = {}, {}
    for cp in [*range(0x80, 0xD800), *range(0xF900, 0x10000), *range(0x1EE00, 0x1EF00)]:
        c = chr(cp)
        tag = unicodedata.decomposition(c).split(" ")[0]
        if tag not in KEPT_TAGS or c in OTHER_LOOK or 0x3D0 <= cp <= 0x3FF:
            continue
        new = unicodedata.normalize("NFKC", c)
        if new.isspace() or new[:1] == " ":
            continue
        (one if len(new) == 1 else many)[c] = new
    many = {k: v for k, v in many.items() if ord(k) < 0x2200 or 0xFB00 <= ord(k) < 0xFB50}
    ink = [c for c in map(chr, [*range(0x80, 0x3200), *range(0xFE00, 0x10000)]) if unicodedata.category(c) == "Cf"]
    ink += ["͏", "ᅟ", "ᅠ", "ㅤ", "ﾠ", *map(chr, range(0x180B, 0x180E)), *map(chr, range(0xFE00, 0xFE10))]
    no_ink = "".join(c for c in ink if c not in (ZWJ, ZWNJ) and not 0x600 <= ord(c) <= 0x605 and ord(c) not in (0x6DD, 0x70F, 0x202D, 0x202E) and not 0xFFF0 <= ord(c))
    return one | _look_alikes(), many, no_ink


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def unify_sql(column: str = "text") -> str:
    """The rewriting as one DuckDB expression over ``column``."""
    one, many, no_ink = tables()
    blanks = "".join(c for c in map(chr, range(0x80, 0x3001)) if unicodedata.category(c) == "Zs") + "\t"
    emoji = r"\x{2190}-\x{2BFF}\x{1F000}-\x{1FAFF}\x{E0020}-\x{E007F}"
    arabic = r"\x{0620}-\x{06FF}\x{0750}-\x{077F}"
    virama = r"\x{094D}\x{09CD}\x{0A4D}\x{0ACD}\x{0B4D}\x{0BCD}\x{0C4D}\x{0CCD}\x{0D4D}\x{0DCA}"
    name = x = f'"{column}"'
    x = f"translate({x}, {_q(no_ink)}, '')"
    for _ in range(2):  # the match takes its right neighbour, so every second joiner waits for the next turn
        x = f"regexp_replace({x}, '([{emoji}])‍([{emoji}])', '\\1{HOLD_JOIN}\\2', 'g')"
        x = f"regexp_replace({x}, '([{arabic}])‌([{arabic}])', '\\1{HOLD_SPLIT}\\2', 'g')"
    x = f"regexp_replace({x}, '([{virama}])‍', '\\1{HOLD_JOIN}', 'g')"
    x = f"regexp_replace({x}, '([{virama}])‌', '\\1{HOLD_SPLIT}', 'g')"
    x = f"translate({x}, {_q(HOLD_JOIN + HOLD_SPLIT + ZWJ + ZWNJ)}, {_q(ZWJ + ZWNJ)})"
    expand = "t.x"
    for k, v in many.items():
        expand = f"replace({expand}, {_q(k)}, {_q(v)})"
    wide = "".join(many)
    src, dst = "".join(one), "".join(one.values())
    y = f"CASE WHEN regexp_matches(t.x, {_q('[' + wide + ']')}) THEN {expand} ELSE t.x END"
    z = f"translate(nfc_normalize({y}), {_q(src + blanks)}, {_q(dst + ' ' * len(blanks))})"
    z = f"regexp_replace(nfc_normalize({z}), '\\r\\n|[\\r\\x{{0085}}\\x{{2028}}\\x{{2029}}]', chr(10), 'g')"
    tidy = lambda c: f"trim(regexp_replace(regexp_replace({c}, ' +', ' ', 'g'), ' ?\\n ?', chr(10), 'g'), chr(10) || ' ')"
    whole = f"(SELECT {tidy(z)} FROM (SELECT {x} AS x) t)"
    ascii_only = tidy(f"regexp_replace(replace({name}, chr(9), ' '), '\\r\\n|\\r', chr(10), 'g')")
    return f"(CASE WHEN regexp_matches({name}, '[^\\x00-\\x7F]') THEN {whole} ELSE {ascii_only} END)"


def unify(df: DataFrame, column: str = "text", into: str = "unified") -> DataFrame:
    """Add ``into``, the consistent form of ``column``. No shuffle; one DuckDB per task."""
    from pyspark.sql.types import StringType, StructType

    schema = StructType([*(f for f in df.schema.fields if f.name != into)]).add(into, StringType())
    src = df.select(*[f.name for f in schema.fields if f.name != into])
    sql = unify_sql("text")

    def run(batches):
        import duckdb

        con = duckdb.connect(config={"threads": 1})
        for b in batches:
            batch = pa.table({"text": b.column(column).cast(pa.string())})  # noqa: F841, read by DuckDB
            u = con.sql(f"SELECT {sql} AS u FROM batch").to_arrow_table().column("u").cast(pa.string())
            u = pa.concat_arrays(u.chunks) if u.num_chunks else pa.array([], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, u], names=[*b.schema.names, into])

    return src.mapInArrow(run, schema)


def look_classes(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row for each id: ``id, text_key`` (exact text) and ``look_key`` (text as it looks).

    Nulls, empty and blank texts and null ids take no part; repeated rows count once.
    """
    base = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL AND text IS NOT NULL AND text <> ''")
    keyed = unify(base.dropDuplicates(["id"]), "text", "unified").where("unified <> ''")
    return keyed.select("id", F.sha2("text", 256).alias("text_key"), F.sha2("unified", 256).alias("look_key"))


def same_look_pairs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``a, b``: ids whose texts look the same and differ in code points, smaller id first.

    Copies of one exact text are no pair with each other; the join runs between the classes of
    exact texts of one look, then each class is opened to its members.
    """
    rows = cut(look_classes(df, id_col, text_col))  # DuckDB runs once
    classes = cut(rows.select("look_key", "text_key").distinct())
    ta, tb = classes.select("look_key", F.col("text_key").alias("ta")), classes.select("look_key", F.col("text_key").alias("tb"))
    of = rows.select("id", "text_key")
    joined = ta.join(tb, "look_key").where("ta < tb").select("ta", "tb")
    joined = joined.join(of.select(F.col("id").alias("x"), F.col("text_key").alias("ta")), "ta")
    joined = joined.join(of.select(F.col("id").alias("y"), F.col("text_key").alias("tb")), "tb")
    return joined.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def same_look_groups(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, group_id, n_texts``: of each id the smallest one that looks the same, and how many different
    texts look so. One row for each id, however many look the same."""
    rows = cut(look_classes(df, id_col, text_col))
    texts = rows.groupBy("look_key", "text_key").agg(F.min("id").alias("id")).groupBy("look_key").agg(F.min("id").alias("group_id"), F.count(F.lit(1)).alias("n_texts"))
    return lookup_join(rows.select("id", "look_key"), texts, "look_key").select("id", "group_id", "n_texts")
