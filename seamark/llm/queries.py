"""Queries over the operators of this subpackage, and the SQL that says the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seamark.functions.dist import table
from seamark.llm import components, corpus_encoding, cut_text, eval_leaks, name_variants, near_duplicates, scan_repair, sentence_bounds, unify_text, vector_neighbors


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return vector_neighbors.similar_pairs(table(spark, d, "quad2006")).toDF("chunk_a", "chunk_b")


def p1_search(spark: SparkSession, d: str) -> DataFrame:
    """The five most similar rows of every row whose id is divisible by 100."""
    rows = table(spark, d, "quad2006")
    queries = vector_neighbors.unit_vectors(rows).where("cast(conv(right(id, 8), 16, 10) as bigint) % 100 = 0")
    found = vector_neighbors.search(rows, queries)
    return found.select(F.col("query").alias("query_id"), F.col("id").alias("chunk_id"), F.round("s", 4).alias("similarity"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return scan_repair.repairs(table(spark, d, "extracted_docs"), table(spark, d, "rder_elements"))


def p2_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return scan_repair.paragraphs(table(spark, d, "extracted_docs"), table(spark, d, "rder_elements"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return unify_text.same_look_pairs(table(spark, d, "unicode_mixed"), "chunk_id", "text").toDF("chunk_a", "chunk_b")


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    """Of each chunk the smallest one that looks the same, and how many different texts look so."""
    return unify_text.same_look_groups(table(spark, d, "unicode_mixed"), "chunk_id", "text").toDF("chunk_id", "group_id", "n_texts")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "extracted_docs").where("extractor = 'native'")
    return sentence_bounds.sentences(docs).drop("text")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return components.mention_groups(table(spark, d, "mentions"), table(spark, d, "mention_matches"), table(spark, d, "linked_entities"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return name_variants.same_entity_pairs(table(spark, d, "mentions"), table(spark, d, "linked_entities")).toDF("canonical_a", "canonical_b")


def p6_groups(spark: SparkSession, d: str) -> DataFrame:
    """Of each canonical id of a person or organisation the smallest one that means the same."""
    g = name_variants.same_entities(table(spark, d, "mentions"), table(spark, d, "linked_entities"))
    smallest = g.groupBy("group_id").agg(F.min("cid").alias("canonical_group"), F.count(F.lit(1)).alias("n"))
    return g.join(smallest, "group_id").select(F.col("cid").alias("canonical_id"), "canonical_group", "n")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates.near_duplicate_pairs(table(spark, d, "rder_elements"), "element_id", "text").toDF("element_a", "element_b")


def p7_classes(spark: SparkSession, d: str) -> DataFrame:
    """Of each element its class of equal sets of words (named by the smallest element), the copies in it, and
    the number of other classes that are nearly the same."""
    return near_duplicates.linked_classes(table(spark, d, "rder_elements"), "element_id", "text").toDF("element_id", "class_id", "copies", "n_links")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return corpus_encoding.encode(table(spark, d, "documents"))


def p8_decoded(spark: SparkSession, d: str) -> DataFrame:
    return corpus_encoding.decode(corpus_encoding.encode(table(spark, d, "documents")))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return eval_leaks.leaks(table(spark, d, "documents"), table(spark, d, "benchmark")).select("doc_id", "item_id")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return cut_text.cut_documents(table(spark, d, "documents")).where("is_cut").select("doc_id")


def p10_sources(spark: SparkSession, d: str) -> DataFrame:
    """How often each source cuts texts."""
    judged = cut_text.cut_documents(table(spark, d, "documents"))
    return judged.groupBy("source").agg(F.count(F.lit(1)).alias("n_texts"), F.count_if("is_cut").alias("n_cut"), F.round(F.avg(F.col("is_cut").cast("int")), 6).alias("share"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_search, p2_found, p2_paragraphs, p3_found, p3_groups, p4_found, p5_found, p6_found, p6_groups, p7_found, p7_classes, p8_ids, p8_decoded, p9_found, p10_found, p10_sources)}


P1 = """
WITH v AS (SELECT chunk_id, any_value(model) AS model, any_value(embedding) AS e, any_value(dim) AS dim FROM quad2006
           WHERE chunk_id IS NOT NULL AND model IS NOT NULL AND embedding IS NOT NULL GROUP BY chunk_id),
u AS (SELECT chunk_id, model, list_transform(e, lambda x: x::DOUBLE) AS e FROM v
      WHERE len(e) = dim AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
s AS (SELECT a.chunk_id AS a, b.chunk_id AS b, round(list_cosine_similarity(a.e, b.e), 12) AS s FROM u a JOIN u b ON a.model = b.model AND a.chunk_id <> b.chunk_id),
r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY s DESC, b) AS n FROM s)
SELECT DISTINCT least(a, b) AS chunk_a, greatest(a, b) AS chunk_b FROM r WHERE n <= 5 AND s >= 0.8
"""

P5 = """
WITH RECURSIVE star AS (SELECT list_filter(mention_ids, lambda x: x IS NOT NULL) AS m FROM linked_entities),
e AS (SELECT mention_a AS a, mention_b AS b FROM mention_matches UNION ALL SELECT m[1], unnest(m) FROM star WHERE len(m) > 0),
ids AS (SELECT mention_id AS id FROM mentions WHERE mention_id IS NOT NULL UNION SELECT a FROM e WHERE a IS NOT NULL UNION SELECT b FROM e WHERE b IS NOT NULL),
both_ways AS (SELECT DISTINCT a, b FROM (SELECT a, b FROM e UNION ALL SELECT b, a FROM e) WHERE a <> b),
reach AS (SELECT id AS a, id AS b FROM ids UNION SELECT r.a, x.b FROM reach r JOIN both_ways x ON r.b = x.a)
SELECT a AS mention_id, min(b) AS group_id FROM reach GROUP BY a
"""

P7 = """
WITH t AS (SELECT element_id, any_value(text) AS text FROM rder_elements WHERE text IS NOT NULL AND element_id IS NOT NULL GROUP BY element_id),
w AS (SELECT element_id, regexp_extract_all(lower(regexp_replace(text, '[^A-Za-z0-9]+', ' ', 'g')), '[a-z0-9]+') AS ws FROM t),
l AS (SELECT element_id, list_distinct(ws) AS ws FROM w WHERE len(ws) >= 20),
x AS (SELECT element_id, len(ws) AS n, unnest(ws) AS word FROM l),
c AS (SELECT a.element_id AS a, b.element_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k
      FROM x a JOIN x b ON a.word = b.word AND a.element_id < b.element_id GROUP BY 1, 2)
SELECT a AS element_a, b AS element_b FROM c WHERE k::DOUBLE / (na + nb - k) >= 0.7
"""


P7_CLASSES = P7.replace("\nSELECT a AS element_a", """,
pairs AS (SELECT a, b FROM c WHERE k::DOUBLE / (na + nb - k) >= 0.7),
s AS (SELECT element_id, array_to_string(list_sort(ws), ' ') AS k FROM l),
cl AS (SELECT k, min(element_id) AS class_id, count(*) AS copies FROM s GROUP BY k),
lk AS (SELECT x.class_id, count(DISTINCT y.class_id) AS n FROM (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs) p
       JOIN s sa ON sa.element_id = p.a JOIN cl x ON x.k = sa.k JOIN s sb ON sb.element_id = p.b JOIN cl y ON y.k = sb.k WHERE x.k <> y.k GROUP BY 1)
SELECT element_id, cl.class_id, copies, coalesce(lk.n, 0) AS n_links FROM s JOIN cl ON cl.k = s.k LEFT JOIN lk ON lk.class_id = cl.class_id
--""")


# Looks of single characters, written down apart from the operator's rules: letters of other scripts and the Latin
# one a reader sees, half-width kana and the full ones, other forms and what they stand for.
LOOKS = {
    "а": "a", "е": "e", "о": "o", "с": "c", "р": "p", "х": "x", "у": "y", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ё": "ë",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "У": "Y", "І": "I", "Ј": "J", "Ѕ": "S", "Ё": "Ë",
    "ο": "o", "ν": "v", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ά": "Á", "Ύ": "Ý", "Έ": "É", "Ή": "H\u0301", "Ί": "Í", "Ό": "Ó", "ό": "ó",
    "µ": "μ", "‐": "-", "‑": "-", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl",
    "Ⅰ": "I", "Ⅱ": "II", "Ⅲ": "III", "Ⅳ": "IV", "Ⅴ": "V", "Ⅵ": "VI", "Ⅶ": "VII", "Ⅷ": "VIII", "Ⅸ": "IX", "Ⅹ": "X",
    **dict(zip("ｦｧｨｩｪｫｬｭｮｯｰｱｲｳｴｵｶｷｸｹｺｻｼｽｾｿﾀﾁﾂﾃﾄﾅﾆﾇﾈﾉﾊﾋﾌﾍﾎﾏﾐﾑﾒﾓﾔﾕﾖﾗﾘﾙﾚﾛﾜﾝﾞﾟ", "ヲァィゥェォャュョッーアイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロワン\u3099\u309a", strict=True)),
}
_JOINS = r"x = chr(8205) AND (regexp_matches(before, '[\x{2190}-\x{2BFF}\x{1F000}-\x{1FAFF}]') AND regexp_matches(after, '[\x{2190}-\x{2BFF}\x{1F000}-\x{1FAFF}]') OR regexp_matches(before, '[\x{094D}\x{09CD}\x{0D4D}\x{0DCA}]'))"
_SPLITS = r"x = chr(8204) AND (regexp_matches(before, '[\x{0620}-\x{06FF}]') AND regexp_matches(after, '[\x{0620}-\x{06FF}]') OR regexp_matches(before, '[\x{094D}\x{09CD}\x{0D4D}\x{0DCA}]'))"
LOOKED = rf"""
WITH looks(c, form) AS (VALUES {", ".join(f"('{k}', '{v}')" for k, v in LOOKS.items())}),
t AS (SELECT chunk_id, any_value(text) AS text FROM unicode_mixed WHERE chunk_id IS NOT NULL AND text IS NOT NULL AND text <> '' GROUP BY chunk_id),
k AS (SELECT DISTINCT text FROM t),
ink AS (SELECT text, regexp_replace(text, '[\x{{00AD}}\x{{200B}}\x{{200E}}\x{{200F}}\x{{2060}}\x{{FEFF}}\x{{FE0F}}]', '', 'g') AS x FROM k),
each AS (SELECT text, unnest(regexp_extract_all(x, '(?s).')) AS x, generate_subscripts(regexp_extract_all(x, '(?s).'), 1) AS i FROM ink),
beside AS (SELECT *, coalesce(lag(x) OVER w, '') AS before, coalesce(lead(x) OVER w, '') AS after FROM each WINDOW w AS (PARTITION BY text ORDER BY i)),
kept AS (SELECT * FROM beside WHERE x NOT IN (chr(8204), chr(8205)) OR {_JOINS} OR {_SPLITS}),
formed AS (SELECT text, i, CASE WHEN x IN (chr(13), chr(10)) THEN x WHEN regexp_matches(x, '[\t\x{{00A0}}\p{{Zs}}]') THEN ' ' WHEN ascii(x) BETWEEN 65281 AND 65374 THEN chr(ascii(x) - 65248) ELSE coalesce(l.form, x) END AS y
  FROM kept LEFT JOIN looks l ON l.c = kept.x),
whole AS (SELECT text, nfc_normalize(string_agg(y, '' ORDER BY i)) AS y FROM formed GROUP BY text),
tidy AS (SELECT text, trim(regexp_replace(regexp_replace(regexp_replace(y, '\r\n?', chr(10), 'g'), ' +', ' ', 'g'), ' ?\n ?', chr(10), 'g'), chr(10) || ' ') AS look FROM whole),
u AS (SELECT t.chunk_id, t.text, tidy.look FROM t JOIN tidy ON tidy.text = t.text WHERE look <> '')"""
P3 = LOOKED + """
SELECT a.chunk_id AS chunk_a, b.chunk_id AS chunk_b FROM u a JOIN u b ON a.look = b.look AND a.chunk_id < b.chunk_id AND a.text <> b.text
"""
P3_GROUPS = LOOKED + """
SELECT chunk_id, min(chunk_id) OVER (PARTITION BY look) AS group_id, (SELECT count(DISTINCT v.text) FROM u v WHERE v.look = u.look) AS n_texts FROM u
"""


def oracle_sql() -> dict[str, str]:
    decoded = "SELECT doc_id, coalesce(text, '') AS text FROM documents"
    return {"p1_found": P1, "p3_found": P3, "p3_groups": P3_GROUPS, "p5_found": P5, "p7_found": P7, "p7_classes": P7_CLASSES, "p8_decoded": decoded}
