"""Queries over the core operators, and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seamark.functions.dist import cut, table
from seamark.operators import contract as co
from seamark.operators import elements as el
from seamark.operators import embedding, linking, normalize, promotion
from seamark.operators import entities as en
from seamark.operators import properties as pr
from seamark.plans import reports

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


# SQL that several answers share.
W = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"
DOCS = """docs AS (SELECT doc_id, any_value(coalesce(source_path, '')) AS source_path, any_value(list_transform(coalesce(pages, [text]), lambda p: coalesce(p, ''))) AS pages
    FROM extracted_docs WHERE doc_id IS NOT NULL GROUP BY doc_id)"""
SENT = DOCS + rf""", paged AS (SELECT doc_id, unnest(pages) AS body, generate_subscripts(pages, 1) AS page FROM docs),
    split AS (SELECT doc_id, page, body, string_split(regexp_replace(body, '([.!?]["''”’)\]]*|\n\n+)', '\1' || chr(57344), 'g'), chr(57344)) AS ps FROM paged),
    piece AS (SELECT doc_id, page, body, unnest(ps) AS p, generate_subscripts(ps, 1) AS k FROM split),
    placed AS (SELECT *, coalesce(sum(length(p)) OVER (PARTITION BY doc_id, page ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off_,
        length(p) - length(regexp_replace(p, '^{W}+', '')) AS lead, regexp_replace(regexp_replace(p, '^{W}+', ''), '{W}+$', '') AS core FROM piece),
    sent AS (SELECT doc_id, page, (row_number() OVER (PARTITION BY doc_id, page ORDER BY k) - 1)::INT AS ord, (off_ + lead)::INT AS char_start, (off_ + lead + length(core))::INT AS char_end, core AS text FROM placed WHERE length(core) > 0),
    sentences_ AS (SELECT doc_id, substr(sha1(doc_id || '|' || page || '|' || char_start || '|' || char_end), 1, 16) AS sent_id, page::INT AS page, ord, char_start, char_end, text,
        len(list_filter(regexp_split_to_array(text, '{W}+'), lambda t: t <> ''))::INT AS n FROM sent)"""
CHUNK = SENT + """, seq AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page, ord) AS i FROM sentences_),
    pack AS (SELECT doc_id, i, n AS cur, 0 AS chunk FROM seq WHERE i = 1
        UNION ALL SELECT s.doc_id, s.i, CASE WHEN p.cur + s.n > 512 AND p.cur > 0 THEN s.n ELSE p.cur + s.n END, CASE WHEN p.cur + s.n > 512 AND p.cur > 0 THEN p.chunk + 1 ELSE p.chunk END
        FROM pack p JOIN seq s ON s.doc_id = p.doc_id AND s.i = p.i + 1),
    chunks_ AS (SELECT s.doc_id, substr(sha1(s.doc_id || '|' || arg_min(sent_id, s.i) || '|' || arg_max(sent_id, s.i)), 1, 16) AS chunk_id, chunk::INT AS ord, string_agg(text, ' ' ORDER BY s.i) AS text,
        list(sent_id ORDER BY s.i) AS sentence_ids, min(page)::INT AS page_start, max(page)::INT AS page_end, sum(n)::INT AS n_tokens
        FROM seq s JOIN pack p ON s.doc_id = p.doc_id AND s.i = p.i GROUP BY s.doc_id, chunk)"""


def _docs(s, d):
    return normalize.coerce(table(s, d, "extracted_docs"))


def _sents(s, d):
    return normalize.sentences(_docs(s, d))


def _chunks(s, d):
    return normalize.chunks(_sents(s, d))


@query(f"WITH {SENT} SELECT doc_id, sent_id, page, ord, char_start, char_end, text FROM sentences_")
def sentence_spans(s, d):
    return _sents(s, d)


@query(f"WITH RECURSIVE {CHUNK} SELECT doc_id, chunk_id, ord, text, array_to_string(sentence_ids, ',') AS sentence_ids, page_start, page_end, n_tokens FROM chunks_")
def token_chunks(s, d):
    return _chunks(s, d).withColumn("sentence_ids", F.array_join("sentence_ids", ","))


@query(f"""WITH RECURSIVE {CHUNK} SELECT d.doc_id, sha1(array_to_string(pages, '')) AS doc_sha1, len(pages)::INT AS num_pages,
    (SELECT count(*) FROM sentences_ s WHERE s.doc_id = d.doc_id) AS n_sentences, (SELECT count(*) FROM chunks_ c WHERE c.doc_id = d.doc_id) AS n_chunks FROM docs d""")
def document_summary(s, d):
    return normalize.summary(_docs(s, d), _sents(s, d), _chunks(s, d))


@query(f"""WITH {DOCS}, body AS (SELECT doc_id, unnest(pages) AS body, generate_subscripts(pages, 1) AS page FROM docs),
    s AS (SELECT DISTINCT doc_id, sent_id, page, char_start, char_end, text FROM sentences),
    c AS (SELECT chunk_id, any_value(doc_id) AS doc_id, any_value(text) AS text, any_value(sentence_ids) AS ids, any_value(page_start) AS lo, any_value(page_end) AS hi FROM unicode_mixed WHERE chunk_id IS NOT NULL GROUP BY chunk_id),
    placed AS (SELECT doc_id, sent_id, page, row_number() OVER (PARTITION BY doc_id ORDER BY page NULLS FIRST, char_start NULLS FIRST, sent_id) AS at_ FROM s),
    named AS (SELECT c.doc_id, c.chunk_id, c.lo, c.hi, k, p.page, p.at_ FROM (SELECT *, unnest(ids) AS sid, generate_subscripts(ids, 1) AS k FROM c) c LEFT JOIN placed p ON p.doc_id = c.doc_id AND p.sent_id = c.sid),
    per AS (SELECT doc_id, chunk_id, lo, hi, count(*) FILTER (WHERE at_ IS NULL) AS lost, count(DISTINCT at_ - k) AS runs, min(page) AS plo, max(page) AS phi FROM named GROUP BY ALL)
    SELECT s.doc_id, 'slice_mismatch' AS rule, sent_id AS item FROM s LEFT JOIN body b ON s.doc_id = b.doc_id AND s.page = b.page
    WHERE s.text IS DISTINCT FROM substr(b.body, char_start + 1, char_end - char_start)
    UNION ALL SELECT doc_id, 'over_budget', chunk_id FROM c WHERE len(list_filter(regexp_split_to_array(text, '{W}+'), lambda t: t <> '')) > 20 AND len(ids) > 1
    UNION ALL SELECT doc_id, 'unknown_sentence', chunk_id FROM per WHERE lost > 0
    UNION ALL SELECT doc_id, 'not_consecutive', chunk_id FROM per WHERE lost = 0 AND runs > 1
    UNION ALL SELECT doc_id, 'page_range', chunk_id FROM per WHERE lost = 0 AND (plo <> lo OR phi <> hi)""")
def stored_sentence_violations(s, d):
    """The stored sentences against their pages, and the stored chunks against the sentences, with a budget of 20."""
    stored = table(s, d, "unicode_mixed").where("chunk_id IS NOT NULL").dropDuplicates(["chunk_id"])
    return normalize.violations(_docs(s, d), table(s, d, "sentences"), stored, 20)


@query(f"""WITH RECURSIVE {CHUNK} SELECT d.doc_id, len(pages)::INT AS num_pages, source_path, sha1(array_to_string(pages, '')) AS doc_sha1,
    (SELECT string_agg(sent_id, ',' ORDER BY page, ord) FROM sentences_ s WHERE s.doc_id = d.doc_id) AS sent_ids, (SELECT string_agg(chunk_id || ':' || text, ',' ORDER BY ord) FROM chunks_ c WHERE c.doc_id = d.doc_id) AS chunk_texts FROM docs d""")
def normalized_documents(s, d):
    """The nested form of documents, flattened again."""
    n = normalize.normalized(_docs(s, d), _sents(s, d), _chunks(s, d))
    ids = F.transform("sentences", lambda x: x["sent_id"])
    texts = F.transform("chunks", lambda x: F.concat_ws(":", x["chunk_id"], x["text"]))
    some = lambda c: F.when(F.size(c) > 0, F.array_join(c, ","))
    return n.select("doc_id", "doc.num_pages", "doc.source_path", "meta.doc_sha1", some(ids).alias("sent_ids"), some(texts).alias("chunk_texts"))


@query(f"WITH {DOCS} SELECT doc_id AS name, unnest(['missing key: images', 'doc missing: num_pages']) AS rule FROM docs WHERE len(pages) % 2 = 0")
def normalized_schema_violations(s, d):
    """The normalized form as JSON text against its schema; documents of an even number of pages lose two keys."""
    n = normalize.normalized(_docs(s, d), _sents(s, d), _chunks(s, d))
    whole = F.to_json(F.struct("meta", "doc", "sentences", "chunks", "images"))
    less = F.to_json(F.struct("meta", F.col("doc").dropFields("num_pages").alias("doc"), "sentences", "chunks"))
    return normalize.schema_violations(n.select(F.col("doc_id").alias("name"), F.when(F.col("doc.num_pages") % 2 == 0, less).otherwise(whole).alias("value")))


@query("""SELECT doc_id, st AS start, substr(text, st + 1, 1200) AS text FROM (SELECT doc_id, text, unnest(range(0, length(text), 1000))::INT AS st FROM documents WHERE text IS NOT NULL AND text <> '')""")
def fixed_windows(s, d):
    return normalize.fixed_windows(table(s, d, "documents"))


def _entities(s, d):
    return en.extract(_chunks(s, d))


# Case patterns as maximal word tokens: RE2 knows no Unicode word boundary. Where a match starts: the lengths
# of the texts between the matches before it, and of these.
def _hits(kind: str, pattern: str, where: str = "true") -> str:
    return rf"""SELECT doc_id, chunk_id, ord, {kind} AS type, t AS text, st AS start_ FROM (
        SELECT doc_id, chunk_id, ord, unnest(hits) AS t, unnest(list_transform(range(1, len(hits) + 1), lambda i: (list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0))::INT)) AS st
        FROM (SELECT doc_id, chunk_id, ord, regexp_extract_all(text, '{pattern}') AS hits, string_split(regexp_replace(text, '{pattern}', chr(57346), 'g'), chr(57346)) AS gaps FROM chunks_)) WHERE {where}"""


ENT = CHUNK + ", ents AS (" + " UNION ALL ".join([
    _hits("CASE WHEN regexp_full_match(t, '[A-Z]{2,}') THEN 'ORG' ELSE 'PERSON' END", r"[\p{L}\p{M}\p{N}\p{Pc}]+", "regexp_full_match(t, '[A-Z]{2,}|[A-Z][a-z]+')"),
    _hits("'EMAIL'", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"),
    _hits("'URL'", r"(?:https?://|www\.)[^\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]+"),
]) + ")"
MENT = ENT + """, placed_ AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ord, start_, start_ + length(text), type) AS n,
    doc_id || ':' || chunk_id || ':' || start_ || '-' || (start_ + length(text)) || ':' || type AS mention_id FROM ents)"""


@query(f"WITH RECURSIVE {ENT} SELECT type, count(*) AS n, count(DISTINCT text) AS n_texts FROM ents GROUP BY type")
def entity_types(s, d):
    return _entities(s, d).groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("text").alias("n_texts"))


@query(f"WITH RECURSIVE {ENT} SELECT doc_id, chunk_id, type, text, count(*) AS n FROM ents GROUP BY ALL")
def entities(s, d):
    return _entities(s, d).groupBy("doc_id", "chunk_id", "type", "text").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH RECURSIVE {ENT} SELECT substr(sha1(doc_id || '|' || e.chunk_id || '|' || start_ || '|' || (start_ + length(e.text)) || '|' || e.text), 1, 16) AS id, e.doc_id, e.chunk_id, type, e.text,
    start_ AS start, (start_ + length(e.text))::INT AS "end", sha1(c.text) AS source_sha1 FROM ents e JOIN (SELECT chunk_id, text FROM chunks_) c USING (chunk_id)""")
def entity_offsets(s, d):
    return _entities(s, d).select("id", "doc_id", "chunk_id", "type", "text", "start", "end", "source_sha1")


# Chunks with addresses: the catalogue page of a chunk stands behind its text, so that links occur in whole tables.
LINKED = """c0 AS (SELECT chunk_id, any_value(doc_id) AS doc_id, any_value(text) AS text FROM unicode_mixed WHERE chunk_id IS NOT NULL AND text IS NOT NULL GROUP BY chunk_id),
    lt AS (SELECT doc_id, chunk_id, text || ' ACME lists it under https://example.org/' || chunk_id || ' and at www.example.org with NASA ' AS text FROM c0)"""


def _linked_chunks(s, d):
    c = table(s, d, "unicode_mixed").where("chunk_id IS NOT NULL AND text IS NOT NULL").dropDuplicates(["chunk_id"])
    return c.select("doc_id", "chunk_id", F.concat("text", F.lit(" ACME lists it under https://example.org/"), "chunk_id", F.lit(" and at www.example.org with NASA ")).alias("text"))


@query(f"""WITH {LINKED}, {_hits("'ORG'", r"[\p{L}\p{M}\p{N}\p{Pc}]+", "regexp_full_match(t, '[A-Z]{2,}')").replace("ord, ", "").replace("FROM chunks_", "FROM lt").join(["o AS (", ")"])},
    {_hits("'URL'", r"(?:https?://|www\.)[^\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]+").replace("ord, ", "").replace("FROM chunks_", "FROM lt").join(["u AS (", ")"])}
    SELECT o.doc_id, o.chunk_id, o.text AS head, o.start_ AS head_start, arg_min(u.text, u.start_) AS tail, min(u.start_) AS tail_start FROM o JOIN u ON o.chunk_id = u.chunk_id AND u.start_ > o.start_ + length(o.text) GROUP BY ALL""")
def nearest_links(s, d):
    e = en.extract(_linked_chunks(s, d))
    of = lambda p: e.select(F.col("id").alias(f"{p}_ent_id"), F.col("text").alias(p), F.col("start").alias(f"{p}_start"), F.col("type").alias(f"{p}_type"))
    rows = en.links(e).join(of("head").where("head_type = 'ORG'"), "head_ent_id").join(of("tail").where("tail_type = 'URL'"), "tail_ent_id")
    return rows.select("doc_id", "chunk_id", "head", "head_start", "tail", "tail_start")


# Embedded rows: those of quad2006, and the chunks of unicode_mixed that have a page.
HAD = "had AS (SELECT chunk_id FROM quad2006 UNION ALL SELECT chunk_id FROM unicode_mixed WHERE page_start IS NOT NULL)"


def _embedded(s, d):
    return table(s, d, "quad2006").select("chunk_id").unionByName(table(s, d, "unicode_mixed").where("page_start IS NOT NULL").select("chunk_id"))


@query(f"""WITH {HAD}, c AS (SELECT chunk_id, max(doc_id) AS doc_id, arg_max(text, doc_id) AS text FROM unicode_mixed WHERE chunk_id IS NOT NULL GROUP BY chunk_id)
    SELECT q.chunk_id, c.doc_id, coalesce(c.text, '') AS text, count(*) AS n FROM had q JOIN c ON q.chunk_id = c.chunk_id GROUP BY ALL""")
def embedded_chunks(s, d):
    """Embedded rows beside the text of their chunk; those without a chunk are dropped."""
    return en.embedded_chunks(_embedded(s, d), table(s, d, "unicode_mixed")).groupBy("chunk_id", "doc_id", "text").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT canonical_id, arg_max(doc_id, at_) AS doc_id, arg_max(name, at_) AS name FROM (SELECT *, (loaded_at, doc_id, name) AS at_ FROM linked_entities WHERE canonical_id IS NOT NULL AND loaded_at IS NOT NULL AND doc_id IS NOT NULL AND name IS NOT NULL) GROUP BY canonical_id""")
def latest_linked(s, d):
    """Of each canonical id the row that was loaded last."""
    e = table(s, d, "linked_entities").where("loaded_at IS NOT NULL AND doc_id IS NOT NULL AND name IS NOT NULL")
    return promotion.last_rows(e.select("canonical_id", "doc_id", "name", F.struct("loaded_at", "doc_id", "name").alias("at")), "canonical_id", "at").select("canonical_id", "doc_id", "name")


def _mentions(s, d):
    m = en.numbered(en.extract(_chunks(s, d), "ord"))
    return cut(m.select("doc_id", "chunk_id", "mention_id", "type", "text", "start", "end", "sent_no", "n"))


PRONOUNS = ", ".join(f"('{k}', '{a}', '{b}')" for k, (a, b) in en.PRONOUNS.items())
_any = lambda xs: ", ".join(f"'{x}'" for x in xs)
COREF = MENT + f""", pron(form, number_, gender_) AS (VALUES {PRONOUNS}),
    feat AS (SELECT m.*, lower(m.text) AS low, p.form, p.number_,
        CASE WHEN m.type = 'ORG' THEN 'singular' WHEN lower(m.text) IN ('they', 'these', 'those') THEN 'plural' WHEN length(m.text) > 3 AND lower(m.text) LIKE '%s' THEN 'plural' ELSE 'singular' END AS est,
        coalesce(p.gender_, CASE WHEN m.type <> 'PERSON' THEN 'unknown' WHEN lower(m.text) IN ({_any(en.FEM)}) THEN 'fem' WHEN lower(m.text) IN ({_any(en.MASC)}) THEN 'masc' ELSE 'unknown' END) AS gen,
        regexp_matches(lower(m.text), '{"|".join(en.DEVICE_WORDS)}') AS device FROM placed_ m LEFT JOIN pron p ON lower(m.text) = p.form),
    near AS (SELECT p.mention_id, p.form, p.number_, c.mention_id AS cid, c.device, c.n AS cn FROM feat p JOIN feat c ON p.doc_id = c.doc_id AND c.n < p.n AND p.n - c.n <= 30 AND p.form IS NOT NULL
        WHERE CASE WHEN p.form IN ('he', 'him') AND c.gen NOT IN ('masc', 'unknown') THEN false WHEN p.form IN ('she', 'her') AND c.gen NOT IN ('fem', 'unknown') THEN false ELSE c.est = p.number_ END),
    best AS (SELECT *, row_number() OVER (PARTITION BY mention_id ORDER BY (form IN ('it', 'this', 'that') AND device) DESC, cn DESC) AS r FROM near),
    res AS (SELECT f.doc_id, f.mention_id, b.cid AS antecedent_mention_id, CASE WHEN b.cid IS NULL THEN 'unresolved' WHEN f.form IN ('it', 'this', 'that') AND b.device THEN 'prefer_device_over_org' ELSE 'nearest_compatible' END AS coref_rule,
        CASE WHEN b.cid IS NULL THEN 0.0 WHEN f.form IN ('it', 'this', 'that') AND b.device THEN 0.85 WHEN f.form IN ('it', 'this', 'that') OR f.number_ = 'singular' THEN 0.75 ELSE 0.7 END::DOUBLE AS coref_conf
        FROM feat f LEFT JOIN best b ON b.mention_id = f.mention_id AND b.r = 1 WHERE f.form IS NOT NULL)"""


@query(f"WITH RECURSIVE {COREF} SELECT * FROM res")
def coreference(s, d):
    return en.resolve(_mentions(s, d))


@query(f"WITH RECURSIVE {COREF} SELECT coref_rule, count(*) AS n FROM res GROUP BY coref_rule")
def coreference_rules(s, d):
    return en.resolve(_mentions(s, d)).groupBy("coref_rule").agg(F.count(F.lit(1)).alias("n"))


CHAINS = COREF + """, up AS (SELECT m.mention_id, m.doc_id, coalesce(r.antecedent_mention_id, m.mention_id) AS to_ FROM placed_ m LEFT JOIN res r USING (mention_id)),
    walk AS (SELECT mention_id, doc_id, to_, 0 AS k FROM up UNION ALL SELECT w.mention_id, w.doc_id, u.to_, k + 1 FROM walk w JOIN up u ON u.mention_id = w.to_ WHERE u.to_ <> w.to_),
    chain AS (SELECT mention_id, any_value(doc_id) AS doc_id, arg_max(to_, k) AS chain_id FROM walk GROUP BY mention_id)"""


@query(f"WITH RECURSIVE {CHAINS} SELECT doc_id, mention_id, chain_id FROM chain")
def coreference_chains(s, d):
    m = _mentions(s, d)
    return en.chains(m, en.resolve(m))


@query(f"""WITH RECURSIVE {CHAINS} SELECT (SELECT count(*) FROM res) AS pronouns, (SELECT count(*) FROM res WHERE antecedent_mention_id IS NOT NULL) AS resolved, (SELECT count(*) FROM res WHERE antecedent_mention_id IS NULL) AS unresolved,
    (SELECT count(DISTINCT (doc_id, chain_id)) FROM chain) AS chains, (SELECT count(*) FROM chain) AS mentions""")
def coreference_report(s, d):
    m = _mentions(s, d)
    r = en.resolve(m)
    return reports.coreference_report(r, en.chains(m, r))


# Mentions with what is needed for properties of documents: organisations as the type ORG, linked ones with their id.
PROPS = """lm AS (SELECT m, min(canonical_id) AS cid FROM (SELECT canonical_id, unnest(mention_ids) AS m FROM linked_entities WHERE canonical_id IS NOT NULL) WHERE m IS NOT NULL GROUP BY m),
    mm AS (SELECT mention_id, any_value(doc_id) AS doc_id, any_value(CASE type WHEN 'ORGANIZATION' THEN 'ORG' ELSE type END) AS kind, any_value(label) AS text FROM mentions WHERE mention_id IS NOT NULL GROUP BY mention_id),
    me AS (SELECT mm.*, CASE WHEN kind IN ('PERSON', 'ORG') THEN lm.cid END AS entity, row_number() OVER (PARTITION BY doc_id ORDER BY mention_id) AS n FROM mm LEFT JOIN lm ON lm.m = mm.mention_id)"""


def _property_mentions(s, d):
    of = table(s, d, "linked_entities").where("canonical_id IS NOT NULL").select("canonical_id", F.explode("mention_ids").alias("mention_id")).groupBy("mention_id").agg(F.min("canonical_id").alias("cid"))
    m = table(s, d, "mentions").where("mention_id IS NOT NULL").dropDuplicates(["mention_id"])
    m = m.select("doc_id", "mention_id", F.when(F.col("type") == "ORGANIZATION", "ORG").otherwise(F.col("type")).alias("type"), F.col("label").alias("text"))
    m = m.join(of, "mention_id", "left").withColumn("entity_id", F.when(F.col("type").isin("PERSON", "ORG"), F.col("cid"))).drop("cid")
    return pr.rank_in_document(m, "mention_id")


GROUPED = PROPS + f""", bk AS (SELECT *, CASE WHEN kind = 'PERSON' THEN 'people' WHEN kind = 'ORG' THEN 'orgs' WHEN kind IN ({_any(pr.THINGS)}) THEN 'things' END AS bucket,
        regexp_replace(lower(regexp_replace(regexp_replace(coalesce(text, ''), '^{W}+', ''), '{W}+$', '')), '^(the|a|an){W}+', '') AS low FROM me),
    kk AS (SELECT *, CASE WHEN bucket = 'things' THEN coalesce(entity, nullif(CASE WHEN low LIKE '%ies' AND length(low) > 3 THEN left(low, -3) || 'y' WHEN low LIKE '%ses' AND length(low) > 3 THEN left(low, -2) WHEN low LIKE '%s' AND low NOT LIKE '%ss' THEN left(low, -1) ELSE low END, ''), mention_id)
        ELSE coalesce(entity, mention_id) END AS key FROM bk WHERE bucket IS NOT NULL),
    gr AS (SELECT doc_id, bucket, key, arg_min_null(text, n) AS name, arg_min(kind, n) AS class, any_value(entity) AS entity_id, count(*) AS n, string_agg(mention_id, ',' ORDER BY n) AS mention_ids FROM kk GROUP BY ALL)"""


@query(f"WITH {GROUPED} SELECT doc_id, bucket, key, name, class, entity_id, n, mention_ids FROM gr")
def property_groups(s, d):
    """People, organisations and things of each document."""
    return pr.groups(_property_mentions(s, d)).withColumn("mention_ids", F.array_join("mention_ids", ","))


@query(f"WITH {GROUPED} SELECT doc_id, key, n FROM gr WHERE bucket = 'things' AND n >= 2")
def frequent_things(s, d):
    return pr.groups(_property_mentions(s, d), least_things=2).where("bucket = 'things'").select("doc_id", "key", "n")


@query(f"WITH {PROPS} SELECT doc_id, 'where' AS bucket, text AS value, kind AS grain, mention_id FROM me WHERE kind IN ('GPE', 'LOCATION', 'FACILITY')")
def property_places(s, d):
    return pr.places_and_times(_property_mentions(s, d)).drop("n")


@query(f"""WITH {GROUPED}, {DOCS}, f AS (SELECT doc_id, coalesce(pages[1], '') AS b FROM docs),
    v AS (SELECT doc_id, least(5, len(regexp_extract_all(b, '\\b(?:20\\d{{2}}|19\\d{{2}})-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\\d|3[01])\\b')) + len(regexp_extract_all(b, '(?i)\\b(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\\s+\\d{{1,2}},\\s*(?:20\\d{{2}}|19\\d{{2}})\\b'))
        + len(regexp_extract_all(b, '\\b(?:20\\d{{2}}|19\\d{{2}})\\b'))) AS dates FROM f),
    e AS (SELECT doc_id FROM docs UNION SELECT doc_id FROM me)
    SELECT e.doc_id, (SELECT count(*) FROM gr WHERE gr.doc_id IS NOT DISTINCT FROM e.doc_id AND bucket = 'people') AS persons, (SELECT count(*) FROM gr WHERE gr.doc_id = e.doc_id AND bucket = 'orgs') AS orgs, coalesce(v.dates, 0)::BIGINT AS dates,
    (SELECT count(*) FROM me WHERE me.doc_id = e.doc_id AND kind IN ('GPE', 'LOCATION', 'FACILITY')) AS locations, (SELECT count(*) FROM gr WHERE gr.doc_id = e.doc_id AND bucket = 'things') AS things,
    (SELECT count(*) FROM me WHERE me.doc_id = e.doc_id) AS mentions_total FROM e LEFT JOIN v ON v.doc_id = e.doc_id""")
def property_statistics(s, d):
    return pr.statistics(_property_mentions(s, d), _docs(s, d))


@query(f"""WITH {GROUPED}, {DOCS} SELECT me.doc_id, any_value(CASE WHEN d.doc_id IS NOT NULL THEN sha1(array_to_string(d.pages, '')) END) AS source_sha1, count(*) AS mentions_total,
    (SELECT string_agg(coalesce(name, '') || '=' || n, ',' ORDER BY n DESC, coalesce(name, ''), class, entity_id) FROM gr WHERE gr.doc_id = me.doc_id AND bucket = 'people') AS people,
    (SELECT string_agg(coalesce(name, '') || '=' || n, ',' ORDER BY n DESC, coalesce(name, ''), class, entity_id) FROM gr WHERE gr.doc_id = me.doc_id AND bucket = 'things') AS things
    FROM me LEFT JOIN docs d ON d.doc_id = me.doc_id GROUP BY me.doc_id""")
def document_properties(s, d):
    """The nested form of properties, flattened again."""
    p = pr.document_properties(_property_mentions(s, d), _docs(s, d))
    flat = lambda c: F.when(F.size(c) > 0, F.array_join(F.transform(c, lambda x: F.concat_ws("=", x["name"], x["count"])), ","))
    return p.select("doc_id", "source_sha1", "stats.mentions_total", flat("who.people").alias("people"), flat("how.things").alias("things"))


@query(f"WITH {GROUPED}, t AS (SELECT coalesce(name, '') AS name, sum(n)::BIGINT AS n FROM gr WHERE bucket = 'people' GROUP BY ALL ORDER BY n DESC, name LIMIT 10) SELECT name, n FROM t WHERE name <> ''")
def top_people(s, d):
    return pr.top_names(pr.groups(_property_mentions(s, d)), "people")


@query(f"WITH {GROUPED}, t AS (SELECT coalesce(name, '') AS name, sum(n)::BIGINT AS n FROM gr WHERE bucket = 'orgs' GROUP BY ALL ORDER BY n DESC, name LIMIT 10) SELECT name, n FROM t WHERE name <> ''")
def top_organizations(s, d):
    return pr.top_names(pr.groups(_property_mentions(s, d)), "orgs")


@query(rf"""WITH {DOCS}, f AS (SELECT doc_id, coalesce(pages[1], '') AS b FROM docs),
    v AS (SELECT doc_id, list_concat(list_concat(list_transform(list_filter(regexp_extract_all(b, '\b\d{{4}}-\d{{2}}-\d{{2}}\b'), lambda x: x[1:2] IN ('19', '20') AND x[6:7]::INT BETWEEN 1 AND 12 AND x[9:10]::INT BETWEEN 1 AND 31), lambda x: x),
        regexp_extract_all(b, '(?i)\b(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\s+\d{{1,2}},\s*(?:19|20)\d{{2}}\b')), regexp_extract_all(b, '\b(?:19|20)\d{{2}}\b'))[1:5] AS ds FROM f)
    SELECT doc_id, (generate_subscripts(ds, 1) - 1)::INT AS ord, unnest(ds) AS value, CASE WHEN length(unnest(ds)) = 4 THEN 'year' ELSE 'day' END AS grain FROM v""")
def fallback_dates(s, d):
    return pr.fallback_dates(_docs(s, d))


@query(rf"""WITH {DOCS}, k AS (SELECT doc_id, nullif(string_split(source_path, '/')[-1], '') AS filename FROM docs)
    SELECT doc_id, filename, CASE WHEN lower(filename) LIKE '%.pdf' THEN 'pdf' WHEN lower(filename) LIKE '%.ppt' OR lower(filename) LIKE '%.pptx' THEN 'presentation'
    WHEN lower(filename) LIKE '%.doc' OR lower(filename) LIKE '%.docx' THEN 'document' WHEN lower(filename) LIKE '%.txt' THEN 'text' END AS doc_type FROM k""")
def document_types(s, d):
    return pr.doc_types(_docs(s, d))


GROUPS = rf"""m AS (SELECT mention_id, any_value(doc_id) AS doc_id, any_value(type) AS type, any_value(coalesce(label, '')) AS label FROM mentions WHERE mention_id IS NOT NULL GROUP BY mention_id),
    k AS (SELECT doc_id, mention_id, upper(coalesce(nullif(regexp_replace(regexp_replace(type, '^{W}+', ''), '{W}+$', ''), ''), 'UNKNOWN')) AS type, label, regexp_replace(regexp_replace(label, '^{W}+', ''), '{W}+$', '') AS trimmed FROM m),
    sp AS (SELECT doc_id, type, lower(trimmed) AS normalized_label, label, any_value(trimmed) AS trimmed, count(*) AS n, list(mention_id) AS ids FROM k GROUP BY ALL),
    g AS (SELECT doc_id, type, normalized_label, arg_min(trimmed, (-n, label)) AS name, list_sort(flatten(list(ids))) AS mention_ids FROM sp GROUP BY ALL),
    h AS (SELECT *, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('{linking.ID_PREFIX}' || type || '|' || normalized_label)) AS x FROM g),
    linked AS (SELECT doc_id, substr(x, 1, 8) || '-' || substr(x, 9, 4) || '-5' || substr(x, 14, 3) || '-' || substr('89ab', (('0x' || substr(x, 17, 1))::INT & 3) + 1, 1) || substr(x, 18, 3) || '-' || substr(x, 21, 12) AS canonical_id,
        type, normalized_label, name, mention_ids FROM h)"""


@query(f"WITH {GROUPS} SELECT doc_id, canonical_id, type, normalized_label, name, array_to_string(mention_ids, ',') AS mention_ids FROM linked")
def link_groups(s, d):
    return linking.groups(table(s, d, "mentions")).withColumn("mention_ids", F.array_join("mention_ids", ","))


@query(f"WITH {GROUPS} SELECT min(canonical_id) AS canonical_id, type, normalized_label, min(name) AS primary_name FROM linked GROUP BY type, normalized_label")
def registry(s, d):
    return linking.register(linking.groups(table(s, d, "mentions")))


@query(f"WITH {GROUPS} SELECT DISTINCT canonical_id, name AS alias FROM linked WHERE name <> ''")
def registry_aliases(s, d):
    return linking.register_aliases(linking.groups(table(s, d, "mentions")))


CACHE = """c AS (SELECT lower(name) AS normalized_name, max(e.id) AS external_id FROM (SELECT name, unnest(external_ids) AS e FROM linked_entities WHERE name IS NOT NULL) GROUP BY 1)"""


def _linked_ids(s, d):
    rows = table(s, d, "linked_entities").where("name IS NOT NULL").select("name", F.explode("external_ids").alias("e"))
    cache = rows.select(F.concat(F.lit("any|"), F.lower("name")).alias("key"), F.col("e.id").alias("id"))
    return linking.external_ids(linking.groups(table(s, d, "mentions")), cache, "registry", ("ORG", "ORGANIZATION"))


@query(f"""WITH {GROUPS}, {CACHE} SELECT l.doc_id, l.canonical_id, CASE WHEN l.type IN ('ORG', 'ORGANIZATION') THEN c.external_id END AS external_id FROM linked l
    LEFT JOIN c ON c.normalized_name = lower(regexp_replace(regexp_replace(l.name, '^{W}+', ''), '{W}+$', ''))""")
def linked_external_ids(s, d):
    return _linked_ids(s, d).select("doc_id", "canonical_id", "external_id")


@query(f"""WITH {GROUPS}, {CACHE} SELECT min(l.canonical_id) AS canonical_id, 'registry' AS source, c.external_id FROM linked l JOIN c ON c.normalized_name = lower(l.name) WHERE l.type IN ('ORG', 'ORGANIZATION') AND c.external_id <> '' GROUP BY c.external_id""")
def registry_external_ids(s, d):
    return linking.register_external_ids(_linked_ids(s, d))


@query(f"""WITH {GROUPS}, {CACHE} SELECT l.doc_id, l.canonical_id, l.type, l.name, array_to_string(mention_ids, ',') AS mention_ids,
    coalesce(CASE WHEN l.type IN ('ORG', 'ORGANIZATION') THEN 'registry:' || c.external_id END, '') AS external_ids FROM linked l LEFT JOIN c ON c.normalized_name = lower(l.name)""")
def linked_rows(s, d):
    """Linked entities in the form they are written, lists as text."""
    x = _linked_ids(s, d)
    rows = linking.linked_rows(x, [x])
    ids = F.transform("external_ids", lambda e: F.concat_ws(":", e["source"], e["id"]))
    return rows.select("doc_id", "canonical_id", "type", "name", F.array_join("mention_ids", ",").alias("mention_ids"), F.array_join(ids, ",").alias("external_ids"))


EMBEDDED = f"""c AS (SELECT chunk_id, any_value(doc_id) AS doc_id, any_value(text) AS text FROM unicode_mixed WHERE text IS NOT NULL AND chunk_id IS NOT NULL GROUP BY chunk_id),
    w AS (SELECT *, list_filter(regexp_split_to_array(text, '{W}+'), lambda t: t <> '') AS ws FROM c),
    t AS (SELECT chunk_id, doc_id, len(ws) > 12 AS truncated, CASE WHEN len(ws) > 12 THEN array_to_string(ws[1:12], ' ') ELSE text END AS text FROM w)"""


@query(f"WITH {EMBEDDED} SELECT doc_id, chunk_id, truncated, 'local-deterministic' AS model, 64 AS dim, sha1(text) AS text_sha1, 64::BIGINT AS n_values FROM t")
def local_embeddings(s, d):
    """Texts cut after 12 words and embedded."""
    rows = table(s, d, "unicode_mixed").where("text IS NOT NULL AND chunk_id IS NOT NULL").dropDuplicates(["chunk_id"])
    return embedding.embed(rows, max_tokens=12).withColumn("n_values", F.size("embedding").cast("bigint")).drop("embedding")


@query(f"WITH {EMBEDDED}, {HAD} SELECT text_sha1, chunk_id FROM (SELECT sha1(text) AS text_sha1, chunk_id FROM t) WHERE chunk_id NOT IN (SELECT chunk_id FROM had WHERE chunk_id IS NOT NULL)")
def embeddings_to_do(s, d):
    """What is left to embed once some rows are there."""
    rows = table(s, d, "unicode_mixed").where("text IS NOT NULL AND chunk_id IS NOT NULL").dropDuplicates(["chunk_id"])
    had = _embedded(s, d).where("chunk_id IS NOT NULL").distinct()
    first = embedding.embed(rows.join(had, "chunk_id", "left_semi"), max_tokens=12)
    return embedding.embed(rows, max_tokens=12, done=first).select("text_sha1", "chunk_id")


@query("SELECT chunk_id, model, len(e) AS n_values, round(list_sum(list_transform(e, lambda x: x::FLOAT::DOUBLE)), 4) AS total FROM (SELECT DISTINCT chunk_id, model, embedding AS e FROM quad2006 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: isnan(x))) = 0)")
def vector_index(s, d):
    """Stored vectors in the form of the index: their lengths and sums."""
    rows = table(s, d, "quad2006").where("embedding IS NOT NULL AND NOT exists(embedding, x -> isnan(x))").select("doc_id", "chunk_id", "model", "embedding").dropDuplicates(["chunk_id", "model"])
    total = F.aggregate("vector", F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double"))
    return embedding.index(rows).select("chunk_id", "model", F.size("vector").cast("bigint").alias("n_values"), F.round(total, 4).alias("total"))


# Types of linked entities as types of the contract, and their labels.
KIND = {"ORGANIZATION": "dbo_Organisation", "PERSON": "kb_Person", "LOCATION": "dbo_Location", "FACILITY": "dbo_Location", "PRODUCT": "kb_Tool", "DEVICE": "kb_Component", "SYSTEM": "kb_System"}
LABEL = {"ORGANIZATION": "Organization", "PERSON": "Person", "LOCATION": "Location", "FACILITY": "Location", "PRODUCT": "Tool", "DEVICE": "Component", "SYSTEM": "System"}
# Predicates by the types of both ends; the rest are related, and some do not fit the contract.
PREDICATES = [("ORGANIZATION", "ORGANIZATION", "SEEKS_PARTNER"), ("PERSON", "ORGANIZATION", "MEMBER_OF"), ("ORGANIZATION", "LOCATION", "LOCATED_IN"), ("ORGANIZATION", "FACILITY", "LOCATED_IN"), ("ORGANIZATION", "PRODUCT", "USES_TOOL"), ("PERSON", "PERSON", "KNOWS"), ("LOCATION", "ORGANIZATION", "FUNDS"), ("PERSON", "PRODUCT", "USES_TOOL")]


def _relations(s, d):
    """Relation mentions: of matched mentions the entities are partners, and neighbours in a document (in the
    order of ids, within one of 16 parts of it) are related by what they are."""
    e = table(s, d, "linked_entities").where("canonical_id IS NOT NULL")
    of = e.select("canonical_id", "doc_id", F.explode("mention_ids").alias("m")).where("m IS NOT NULL").distinct()
    mm = table(s, d, "mention_matches").select("mention_a", "mention_b", "score", "matcher").distinct()
    a, b = of.select(F.col("m").alias("mention_a"), F.col("canonical_id").alias("subj"), "doc_id"), of.select(F.col("m").alias("mention_b"), F.col("canonical_id").alias("obj"))
    score = F.nanvl("score", F.lit(None).cast("double"))
    predicate = F.when(F.col("matcher") == "manual", "RELATED_TO").when(score > 0.8, "SEEKS_PARTNER").otherwise("BOGUS")
    matched = mm.join(a, "mention_a").join(b, "mention_b").select("subj", predicate.alias("predicate"), "obj", "doc_id", F.col("mention_a").alias("sent_id"), F.concat_ws("~", "mention_a", "mention_b").alias("mention_id"), F.round(score, 4).alias("confidence"), F.create_map(F.lit("matcher"), "matcher").alias("props"))
    w = Window.partitionBy("doc_id", F.substring(F.md5("canonical_id"), 1, 1)).orderBy("canonical_id", "type")
    n = e.select("canonical_id", "doc_id", "type").distinct().withColumns({"obj": F.lead("canonical_id").over(w), "to": F.lead("type").over(w)}).where("obj IS NOT NULL")
    kind = F.coalesce(*[F.when((F.col("type") == x) & (F.col("to") == y), p) for x, y, p in PREDICATES], F.lit("RELATED_TO"))
    near = n.select(F.col("canonical_id").alias("subj"), kind.alias("predicate"), "obj", "doc_id").join(of.select(F.col("canonical_id").alias("subj"), "doc_id", F.col("m").alias("sent_id")), ["subj", "doc_id"])
    mid = F.concat_ws(">", "sent_id", "obj")
    conf = F.round(0.6 + 0.4 * F.conv(F.substring(F.md5(mid), 1, 4), 16, 10).cast("double") / 65535, 4)
    near = near.select("subj", "predicate", "obj", "doc_id", "sent_id", mid.alias("mention_id"), conf.alias("confidence"), F.lit(None).cast("map<string,string>").alias("props"))
    return matched.unionByName(near)


def _canonical(s, d):
    """Linked entities as the contract sees them; half of the persons have an address."""
    e = table(s, d, "linked_entities").where("canonical_id IS NOT NULL").groupBy("canonical_id").agg(F.min("type").alias("t"), F.min("name").alias("name"))
    table_of = lambda m: F.create_map(*[F.lit(x) for kv in m.items() for x in kv])
    known = F.substring(F.md5("canonical_id"), 1, 1) < "8"
    base = F.create_map(F.lit("name"), "name", F.lit("uri"), F.concat(F.lit("urn:"), "canonical_id"))
    key = F.when(known, F.map_concat(base, F.create_map(F.lit("email"), F.concat("canonical_id", F.lit("@example.org"))))).otherwise(base)
    return e.select("canonical_id", F.element_at(table_of(KIND), F.col("t")).alias("type"), F.array_compact(F.array(F.element_at(table_of(LABEL), F.col("t")))).alias("labels"), key.alias("key"))


def _case(column: str, m: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in m.items()) + " END"


def _list(xs) -> str:
    return "[" + ", ".join(f"'{x}'" for x in xs) + "]"


RULES = f"""rr(predicate, dom, ran) AS (VALUES {", ".join(f"('{k}', {_list(d)}, {_list(r)})" for k, (d, r) in co.RELATIONS.items())}),
    er(type, keys) AS (VALUES {", ".join(f"('{k}', {_list(keys)})" for k, (_, keys) in co.ENTITY_TYPES.items())})"""
RELS = f"""e AS (SELECT * FROM linked_entities WHERE canonical_id IS NOT NULL),
    o AS (SELECT DISTINCT canonical_id, doc_id, m FROM (SELECT canonical_id, doc_id, unnest(mention_ids) AS m FROM e) WHERE m IS NOT NULL),
    mt AS (SELECT DISTINCT mention_a, mention_b, CASE WHEN isnan(score) THEN NULL ELSE score END AS score, matcher FROM mention_matches),
    nx AS (SELECT *, lead(canonical_id) OVER v AS obj, lead(type) OVER v AS to_ FROM (SELECT DISTINCT canonical_id, doc_id, type FROM e) WINDOW v AS (PARTITION BY doc_id, substr(md5(canonical_id), 1, 1) ORDER BY canonical_id, type NULLS FIRST)),
    rel AS (SELECT a.canonical_id AS subj, CASE WHEN matcher = 'manual' THEN 'RELATED_TO' WHEN score > 0.8 THEN 'SEEKS_PARTNER' ELSE 'BOGUS' END AS predicate, b.canonical_id AS obj, a.doc_id, mention_a AS sent_id,
            concat_ws('~', mention_a, mention_b) AS mention_id, round(score, 4) AS confidence, matcher AS prop FROM mt JOIN o a ON a.m = mention_a JOIN o b ON b.m = mention_b
        UNION ALL SELECT n.canonical_id, CASE {" ".join(f"WHEN type = '{x}' AND to_ = '{y}' THEN '{p}'" for x, y, p in PREDICATES)} ELSE 'RELATED_TO' END, n.obj, n.doc_id, o.m,
            o.m || '>' || n.obj, round(0.6 + 0.4 * ('0x' || substr(md5(o.m || '>' || n.obj), 1, 4))::INT / 65535, 4), NULL FROM nx n JOIN o ON o.canonical_id = n.canonical_id AND o.doc_id = n.doc_id WHERE n.obj IS NOT NULL),
    numbered_ AS (SELECT *, row_number() OVER (PARTITION BY subj, predicate, obj ORDER BY coalesce(doc_id, 'None'), coalesce(sent_id, 'None'), mention_id) AS r FROM rel WHERE subj <> '' AND obj <> ''),
    ev AS (SELECT subj, predicate, obj, avg(coalesce(confidence, 0)::DECIMAL(20, 17)) AS avg_confidence, count(DISTINCT nullif(sent_id, '')) AS ev_count, count(DISTINCT nullif(doc_id, '')) AS doc_count,
        string_agg(mention_id, ',' ORDER BY r) FILTER (WHERE r <= 20) AS mentions, string_agg(coalesce(doc_id, '?') || '/' || coalesce(sent_id, '?'), ',' ORDER BY r) FILTER (WHERE r <= 3) AS examples,
        arg_min(prop, mention_id) AS prop FROM numbered_ GROUP BY subj, predicate, obj)"""
GATED = RELS + f""", {RULES}, can AS (SELECT canonical_id AS cid, {_case("min(type)", KIND)} AS type, {_case("min(type)", LABEL)} AS label, min(name) AS name, CASE WHEN substr(md5(canonical_id), 1, 1) < '8' THEN canonical_id || '@example.org' END AS email FROM e GROUP BY canonical_id),
    ck AS (SELECT can.*, er.keys IS NOT NULL AS ok, CASE WHEN label IS NULL THEN []::VARCHAR[] ELSE [label] END AS labels, coalesce(list_filter(er.keys, lambda k: coalesce(CASE k WHEN 'name' THEN name WHEN 'uri' THEN 'urn' WHEN 'email' THEN email END, '') = ''), []) AS missing,
        er.keys IS NULL OR len(list_filter(er.keys, lambda k: k NOT IN ('name', 'uri', 'email') OR (k = 'email' AND email IS NULL))) > 0 AS absent FROM can LEFT JOIN er ON er.type = can.type),
    gt AS (SELECT ev.*, s.labels AS sl, t.labels AS tl, list_sort(list_filter([
        CASE WHEN avg_confidence::DOUBLE < 0.7 - 1e-12 OR ev_count < 2 THEN 'below_threshold' END, CASE WHEN dom IS NULL THEN 'predicate_not_allowed' END,
        CASE WHEN s.cid IS NULL THEN 'missing_subject' END, CASE WHEN t.cid IS NULL THEN 'missing_object' END,
        CASE WHEN len(s.missing) > 0 THEN 'missing_keys:subject:' || array_to_string(s.missing, ',') END, CASE WHEN len(t.missing) > 0 THEN 'missing_keys:object:' || array_to_string(t.missing, ',') END,
        CASE WHEN NOT s.ok OR NOT t.ok THEN 'type_constraint_failed' END,
        CASE WHEN dom IS NOT NULL AND s.cid IS NOT NULL AND t.cid IS NOT NULL AND NOT ((dom = ['*'] OR list_has_any(s.labels, dom)) AND (ran = ['*'] OR list_has_any(t.labels, ran))) THEN 'domain_range_mismatch' END
        ], lambda x: x IS NOT NULL)) AS reasons FROM ev LEFT JOIN rr ON rr.predicate = ev.predicate LEFT JOIN ck s ON s.cid = subj LEFT JOIN ck t ON t.cid = obj),
    own AS (SELECT canonical_id AS cid, count(DISTINCT m) AS ev_count, count(DISTINCT doc_id) AS doc_count FROM o GROUP BY canonical_id),
    cand AS (SELECT subj AS cid FROM gt WHERE len(reasons) = 0 UNION SELECT obj FROM gt WHERE len(reasons) = 0 UNION SELECT cid FROM own WHERE ev_count >= 2),
    ge AS (SELECT cand.cid, ck.type, ck.label, list_sort(list_filter([CASE WHEN ck.cid IS NULL THEN 'missing_object' END, CASE WHEN len(missing) > 0 THEN 'missing_keys:' || array_to_string(missing, ',') END,
        CASE WHEN absent THEN 'missing_entity_keys' END, CASE WHEN NOT ok THEN 'type_constraint_failed' END], lambda x: x IS NOT NULL)) AS reasons FROM cand LEFT JOIN ck ON ck.cid = cand.cid)"""


def _gated(s, d):
    return promotion.gate(promotion.evidence(_relations(s, d)), _canonical(s, d), co.rules(s))


def _entity_mentions(s, d):
    """A mention of each linked entity in each of its documents and sentences."""
    e = table(s, d, "linked_entities").where("canonical_id IS NOT NULL")
    return e.select("canonical_id", "doc_id", F.explode("mention_ids").alias("sent_id")).where("sent_id IS NOT NULL").distinct()


def _gated_entities(s, d, gated):
    return promotion.gate_entities(promotion.entity_candidates(promotion.facts(gated), promotion.entity_evidence(_entity_mentions(s, d))), _canonical(s, d), co.rules(s))


_ids = lambda c="mentions": F.array_join(F.transform(c, lambda m: m["mention_id"]), ",")
_pairs = lambda c="examples": F.array_join(F.transform(c, lambda m: F.concat_ws("/", F.coalesce(m["doc_id"], F.lit("?")), F.coalesce(m["sent_id"], F.lit("?")))), ",")


@query(f"WITH {RELS} SELECT subj, predicate, obj, round(avg_confidence, 6) AS avg_confidence, ev_count, doc_count, mentions, prop AS props FROM ev")
def relation_evidence(s, d):
    e = promotion.evidence(_relations(s, d))
    return e.select("subj", "predicate", "obj", F.round(F.col("avg_confidence").cast("double"), 6).alias("avg_confidence"), "ev_count", "doc_count", _ids().alias("mentions"), F.get_json_object("props", "$.matcher").alias("props"))


@query(f"WITH {RELS} SELECT canonical_id, count(DISTINCT m) AS ev_count, count(DISTINCT doc_id) AS doc_count, count(*) AS mention_count FROM o GROUP BY canonical_id")
def entity_evidence(s, d):
    return promotion.entity_evidence(_entity_mentions(s, d))


@query(f"WITH {GATED} SELECT subj, sl[1] AS subj_label, predicate, obj, tl[1] AS obj_label, round(avg_confidence, 6) AS avg_confidence, ev_count, doc_count, mentions, prop, 0.7 AS conf_thr, 2 AS min_ev, '1.0.0' AS version FROM gt WHERE len(reasons) = 0")
def promoted_facts(s, d):
    """Facts in the form they are written, flattened again."""
    f = promotion.fact_rows(_gated(s, d))
    return f.select(F.col("subj.canonical_id").alias("subj"), F.get("subj.labels", F.lit(0)).alias("subj_label"), "predicate", F.col("obj.canonical_id").alias("obj"), F.get("obj.labels", F.lit(0)).alias("obj_label"), F.round("evidence.avg_confidence", 6).alias("avg_confidence"), "evidence.ev_count", "evidence.doc_count", _ids("evidence.mentions").alias("mentions"), F.col("props")["matcher"].alias("prop"), "policy.conf_thr", "policy.min_ev", F.col("provenance.schema_version").alias("version"))


@query(f"WITH {GATED} SELECT subj, predicate, obj, array_to_string(reasons, ';') AS reasons, round(avg_confidence, 6) AS avg_confidence, ev_count, examples, 'relation' AS kind FROM gt WHERE len(reasons) > 0")
def quarantined_relations(s, d):
    q = promotion.quarantine_rows(_gated(s, d))
    return q.select(F.col("subj.canonical_id").alias("subj"), "predicate", F.col("obj.canonical_id").alias("obj"), F.array_join("reasons", ";").alias("reasons"), F.round("evidence.avg_confidence", 6).alias("avg_confidence"), "evidence.ev_count", _pairs().alias("examples"), "kind")


@query(f"WITH {GATED} SELECT ge.cid AS canonical_id, type, label, coalesce(own.ev_count, 0) AS ev_count, coalesce(own.doc_count, 0) AS doc_count FROM ge LEFT JOIN own ON own.cid = ge.cid WHERE len(reasons) = 0")
def promoted_entities(s, d):
    rows = promotion.entity_rows(_gated_entities(s, d, _gated(s, d)), promotion.entity_evidence(_entity_mentions(s, d)))
    return rows.select("canonical_id", "type", F.get("labels", F.lit(0)).alias("label"), "provenance.ev_count", "provenance.doc_count")


@query(f"WITH {GATED} SELECT cid AS canonical_id, type, label, array_to_string(reasons, ';') AS reasons FROM ge WHERE len(reasons) > 0")
def quarantined_entities(s, d):
    q = promotion.quarantined_entities(_gated_entities(s, d, _gated(s, d)))
    return q.select("canonical_id", "type", F.get("labels", F.lit(0)).alias("label"), F.array_join("reasons", ";").alias("reasons"))


@query(f"""WITH {GATED}, x AS (SELECT 'reason' AS kind, unnest(reasons) AS name, 'rel:' || subj || '|' || predicate || '|' || obj AS ex FROM gt WHERE len(reasons) > 0
    UNION ALL SELECT 'predicate', predicate, 'rel:' || subj || '|' || predicate || '|' || obj FROM gt WHERE len(reasons) > 0 UNION ALL SELECT 'entity_reason', unnest(reasons), 'entity:' || cid FROM ge
    UNION ALL SELECT 'entity_type', type, 'entity:' || cid FROM ge WHERE len(reasons) > 0 UNION ALL SELECT 'missing_key', unnest(string_split(replace(r, 'missing_keys:', ''), ',')), 'entity:' || cid FROM (SELECT cid, unnest(reasons) AS r FROM ge) WHERE r LIKE 'missing_keys:%'
    UNION ALL SELECT 'total', 'relations', NULL FROM gt WHERE len(reasons) > 0 UNION ALL SELECT 'total', 'entities', NULL FROM ge WHERE len(reasons) > 0),
    y AS (SELECT kind, name, CASE WHEN length(ex) > 64 THEN left(ex, 63) || '…' ELSE ex END AS ex FROM x)
    SELECT kind, name, count(*) AS n, array_to_string(list_sort(list(ex))[1:5], ' ') AS examples FROM y GROUP BY kind, name""")
def quarantine_summary(s, d):
    gated = cut(_gated(s, d))
    rows = promotion.quarantine_summary(promotion.quarantine(gated), promotion.quarantined_entities(_gated_entities(s, d, gated)))
    return rows.withColumn("examples", F.array_join("examples", " "))


@query(f"""WITH {GATED}, g AS (SELECT subj, predicate, obj, avg(coalesce(confidence, 0)) AS a, count(DISTINCT nullif(sent_id, '')) AS n FROM rel GROUP BY ALL),
    j AS (SELECT g.*, dom, ran, s.labels AS sl, t.labels AS tl, s.type AS st, t.type AS tt, s.missing AS sm, t.missing AS tm, s.cid AS sc, t.cid AS tc FROM g LEFT JOIN rr ON rr.predicate = g.predicate LEFT JOIN ck s ON s.cid = subj LEFT JOIN ck t ON t.cid = obj),
    f AS (SELECT *, (list_contains(dom, '*') OR list_has_any(sl, dom)) AND (list_contains(ran, '*') OR list_has_any(tl, ran)) AS fits FROM j WHERE dom IS NOT NULL AND sc IS NOT NULL AND tc IS NOT NULL),
    x AS (SELECT 'unknown_predicate' AS kind, predicate AS name FROM j WHERE dom IS NULL UNION ALL SELECT 'domain_range', predicate FROM f WHERE NOT fits UNION ALL SELECT 'below_threshold', 'groups' FROM f WHERE fits AND (a < 0.7 OR n < 2)
    UNION ALL SELECT 'missing_key', st || ':' || k FROM (SELECT st, unnest(sm) AS k FROM f WHERE fits) UNION ALL SELECT 'missing_key', tt || ':' || k FROM (SELECT tt, unnest(tm) AS k FROM f WHERE fits)
    UNION ALL SELECT 'relation_groups', 'all' FROM g UNION ALL SELECT 'canon_entities', 'all' FROM can UNION ALL SELECT 'unknown_type', coalesce(can.type, '?') FROM o JOIN can ON can.cid = o.canonical_id WHERE can.type IS NULL OR can.type NOT IN (SELECT type FROM er))
    SELECT kind, name, count(*) AS n FROM x GROUP BY ALL""")
def preflight(s, d):
    can = _canonical(s, d)
    m = _entity_mentions(s, d).join(can.select("canonical_id", "type"), "canonical_id")
    return promotion.preflight_report(m, _relations(s, d), can, co.rules(s))


@query(f"""WITH {GATED} SELECT (SELECT count(*) FROM o) AS mentions_entities, (SELECT count(*) FROM rel WHERE subj <> '' AND obj <> '') AS mentions_relations, (SELECT count(*) FROM gt) AS relation_groups,
    (SELECT count(*) FROM gt WHERE len(reasons) = 0) AS promoted_relations, (SELECT count(*) FROM gt WHERE len(reasons) > 0) AS quarantined_relations,
    (SELECT count(*) FROM ge WHERE len(reasons) = 0) AS promoted_entities, (SELECT count(*) FROM ge WHERE len(reasons) > 0) AS quarantined_entities""")
def promotion_counts(s, d):
    gated = cut(_gated(s, d))
    return promotion.counters(_entity_mentions(s, d), gated, _gated_entities(s, d, gated), _relations(s, d))


SECTIONS = f"""e AS (SELECT element_id, any_value(filename) AS filename, any_value(coalesce(metadata.page_number, 0)) AS page, any_value(ord) AS ord, any_value(coalesce(type, '')) AS type, any_value(text) AS text FROM rder_elements WHERE element_id IS NOT NULL GROUP BY element_id),
    f AS (SELECT * FROM e WHERE length(regexp_replace(text, '{W}', '', 'g')) > 0),
    p AS (SELECT filename, page, ord, element_id, type, unnest(range(0, (length(text) - 1) // 1500 + 1)) AS part, text FROM f),
    q AS (SELECT filename, page, substr(text, part * 1500 + 1, 1500) AS text, type = 'Title' AND part = 0 AS title, row_number() OVER (PARTITION BY filename, page ORDER BY ord, element_id, part) AS i FROM p),
    pk AS (SELECT filename, page, i, length(text) AS cur, 0 AS chunk FROM q WHERE i = 1
        UNION ALL SELECT q.filename, q.page, q.i, CASE WHEN k.cur + 1 + length(q.text) > 1500 OR (q.title AND k.cur >= 500) THEN length(q.text) ELSE k.cur + 1 + length(q.text) END,
        CASE WHEN k.cur + 1 + length(q.text) > 1500 OR (q.title AND k.cur >= 500) THEN k.chunk + 1 ELSE k.chunk END FROM pk k JOIN q ON q.filename = k.filename AND q.page = k.page AND q.i = k.i + 1),
    sec AS (SELECT q.filename, q.page, chunk, string_agg(text, chr(10) ORDER BY q.i) AS text FROM q JOIN pk ON pk.filename = q.filename AND pk.page = q.page AND pk.i = q.i GROUP BY ALL)"""


@query(f"WITH RECURSIVE {SECTIONS} SELECT filename, page, chunk, text, length(text)::INT AS n_chars FROM sec")
def title_sections(s, d):
    return el.title_sections(table(s, d, "rder_elements"))


ASSETS = """a AS (SELECT DISTINCT filename AS doc_id, 'assets/' || element_id || '_pg' || coalesce(metadata.page_number, 0) || '_1.' || CASE type WHEN 'Table' THEN 'csv' ELSE 'png' END AS path, CASE type WHEN 'Table' THEN 'table' ELSE 'image' END AS type,
    CASE type WHEN 'Table' THEN text END AS content FROM rder_elements WHERE element_id IS NOT NULL AND filename IS NOT NULL AND (type = 'Table' OR text IS NULL))"""


def _assets(s, d):
    """Tables as files beside the slides, elements without text as pictures."""
    e = table(s, d, "rder_elements").where("element_id IS NOT NULL AND filename IS NOT NULL AND (type = 'Table' OR text IS NULL)")
    tab = F.col("type") == "Table"
    path = F.concat(F.lit("assets/"), "element_id", F.lit("_pg"), F.coalesce("metadata.page_number", F.lit(0)), F.when(tab, "_1.csv").otherwise("_1.png"))
    return e.select(F.col("filename").alias("doc_id"), path.alias("path"), F.when(tab, "table").otherwise("image").alias("type"), F.when(tab, F.col("text")).alias("content")).distinct()


@query(f"""WITH RECURSIVE {SECTIONS}, {ASSETS}, n AS (SELECT *, replace(path, 'assets/', '') AS name FROM a),
    u AS (SELECT filename AS doc_id, 0 AS k, page, chunk, '' AS name, text, 'text' AS type, nullif(page, 0) AS page_number FROM sec
        UNION ALL SELECT doc_id, CASE type WHEN 'table' THEN 1 ELSE 2 END, 0, 0, name, CASE WHEN type = 'table' AND content IS NOT NULL THEN 'Table Data:' || chr(10) || content ELSE '[' || upper(type) || ': ' || name || ']' END, type, regexp_extract(name, '_pg(\\d+)_', 1)::INT FROM n)
    SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY k, page, chunk, name) - 1)::INT AS chunk_id, text, type, page_number::INT AS page_number FROM u""")
def sections_and_assets(s, d):
    """Chunks of text, then tables, then images of each file."""
    rows = el.with_assets(el.title_sections(table(s, d, "rder_elements")), _assets(s, d))
    return rows.select("doc_id", "chunk_id", "text", "metadata.type", "metadata.page_number")


@query(f"""WITH t AS (SELECT DISTINCT element_id, text FROM rder_elements WHERE element_id IS NOT NULL AND text IS NOT NULL AND NOT regexp_matches(text, '[^\\x00-\\x7F]')),
    h AS (SELECT element_id, regexp_replace(regexp_replace(text, '\\r\\n?', chr(10), 'g'), '(\\S)-\\s*\\n\\s*(\\S)', '\\1\\2', 'g') AS x FROM t),
    k AS (SELECT element_id, regexp_replace(regexp_replace(x, '\\n\\n+', chr(57345), 'g'), '{W}+', ' ', 'g') AS x FROM h)
    SELECT element_id, regexp_replace(regexp_replace(replace(x, chr(57345), chr(10) || chr(10)), '^{W}+', ''), '{W}+$', '') AS text FROM k""")
def cleaned_scan_texts(s, d):
    """Texts of elements of plain ASCII (other texts have no normal form in SQL; tests cover them), cleaned."""
    e = table(s, d, "rder_elements").where("element_id IS NOT NULL AND text IS NOT NULL").select("element_id", "text").distinct()
    return e.where(~F.col("text").rlike(r"[^\x00-\x7F]")).select("element_id", el.clean_scan_text(F.col("text")).alias("text"))


@query("""WITH e AS (SELECT element_id, any_value(filename) AS filename, any_value(coalesce(metadata.page_number, 0)) AS page, any_value(ord) AS ord, any_value(type) AS type, any_value(text) AS text FROM rder_elements WHERE element_id IS NOT NULL GROUP BY element_id)
    SELECT filename, page, string_agg(CASE type WHEN 'Title' THEN '## ' || text WHEN 'ListItem' THEN '- ' || text WHEN 'Table' THEN '[TABLE ON PAGE ' || page || ']' ELSE text END, chr(10) ORDER BY ord, element_id) AS markdown
    FROM e WHERE text IS NOT NULL GROUP BY ALL""")
def page_markdown(s, d):
    return el.page_markdown(table(s, d, "rder_elements"))


@query("""WITH i AS (SELECT doc_id, unnest(imgs) AS i FROM (SELECT doc_id, any_value(images) AS imgs FROM extracted_docs WHERE doc_id IS NOT NULL GROUP BY doc_id))
    SELECT doc_id, i.page AS page, i.sha1 AS sha1, greatest(i.bbox[1] - 20, 0) AS x0, greatest(i.bbox[2] - 20, 0) AS y0, least(i.bbox[3] + 20, 612) AS x1, least(i.bbox[4] + 20, 792) AS y1
    FROM i WHERE len(i.bbox) = 4 AND i.bbox[3] - i.bbox[1] >= 150 AND i.bbox[4] - i.bbox[2] >= 150""")
def picture_boxes(s, d):
    return el.boxes(table(s, d, "extracted_docs"))


@query("""WITH RECURSIVE i AS (SELECT doc_id, unnest(imgs) AS i, generate_subscripts(imgs, 1) AS k FROM (SELECT doc_id, any_value(images) AS imgs FROM extracted_docs WHERE doc_id IS NOT NULL GROUP BY doc_id)),
    b AS (SELECT doc_id, i.page AS page, k, i.bbox AS q FROM i WHERE len(i.bbox) = 4 AND i.page IS NOT NULL),
    start_ AS (SELECT doc_id, page, list({'x0': q[1], 'y0': q[2], 'x1': q[3], 'y1': q[4]} ORDER BY k) AS left_ FROM b GROUP BY ALL),
    grow AS (SELECT doc_id, page, left_[1] AS cur, left_[2:] AS left_, false AS done, 0 AS step FROM start_
        UNION ALL SELECT doc_id, page, CASE WHEN done THEN left_[1] WHEN hit IS NULL THEN cur ELSE {'x0': least(cur.x0, left_[hit].x0), 'y0': least(cur.y0, left_[hit].y0), 'x1': greatest(cur.x1, left_[hit].x1), 'y1': greatest(cur.y1, left_[hit].y1)} END,
            CASE WHEN done THEN left_[2:] WHEN hit IS NULL THEN left_ ELSE list_concat(left_[1:hit - 1], left_[hit + 1:]) END, NOT done AND hit IS NULL, step + 1
        FROM (SELECT *, (list_filter(range(1, len(left_) + 1), lambda n: cur.x0 <= left_[n].x1 + 50 AND left_[n].x0 <= cur.x1 + 50 AND cur.y0 <= left_[n].y1 + 50 AND left_[n].y0 <= cur.y1 + 50))[1] AS hit FROM grow) WHERE NOT done OR len(left_) > 0),
    m AS (SELECT doc_id, page, cur FROM grow WHERE done)
    SELECT doc_id, page, greatest(cur.x0 - 20, 0) AS x0, greatest(cur.y0 - 20, 0) AS y0, least(cur.x1 + 20, 612) AS x1, least(cur.y1 + 20, 792) AS y1 FROM m WHERE cur.x1 - cur.x0 >= 150 AND cur.y1 - cur.y0 >= 150""")
def figures(s, d):
    """Pictures merged, those of some size padded."""
    return el.figures(table(s, d, "extracted_docs"))


@query(f"""WITH {DOCS}, p AS (SELECT doc_id, unnest(pages) AS body, generate_subscripts(pages, 1)::INT AS page FROM docs),
    k AS (SELECT *, (contains(lower(body), 'funding')::INT + contains(lower(body), 'cost share')::INT + contains(lower(body), 'fiscal year')::INT + contains(lower(body), 'fy2')::INT + contains(lower(body), 'budget')::INT + contains(lower(body), 'milestones')::INT) AS keyword_hits, (length(body) - length(replace(body, '$', '')))::INT AS dollars FROM p)
    SELECT doc_id, page, length(regexp_replace(regexp_replace(body, '^{W}+', ''), '{W}+$', '')) < 50 AS is_scan, keyword_hits::INT AS keyword_hits, dollars, keyword_hits >= 2 OR dollars >= 3 AS is_financial FROM k""")
def page_signals(s, d):
    return el.signals(table(s, d, "extracted_docs"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(Q)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
