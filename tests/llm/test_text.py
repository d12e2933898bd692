"""Text operators of the subpackage: nulls, empties, repeats, extra columns, and worked cases."""

import math

import pytest
from pyspark.sql import functions as F

from seamark.llm import corpus_encoding, cut_text, eval_leaks, scan_repair, sentence_bounds, unify_text


# unify_text
LOOKS = [
    ("a", "Café 10 µm waffle"), ("b", "Café​ 10 μm waﬄe"), ("c", "Ｃafé １０ μm waffle "), ("d", "café 10 µm waffle"), ("e", "Cafe 10 µm waffle"),
    ("f", "Café10 µm waffle"), ("g", "Café 1⁰ µm waffle"), ("h", None), ("i", ""), ("j", " ​"), ("k", "\U0001f468‍\U0001f527"), ("l", "\U0001f468\U0001f527"), ("m", "Саfé 10 µm waffle"), ("a", "Café 10 µm waffle"), (None, "x"),
]


def test_same_look(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in LOOKS], "chunk_id string, text string, unified string")
    got = {(r.a, r.b) for r in unify_text.same_look_pairs(df, "chunk_id", "text").collect()}
    same = ["a", "b", "c", "m"]
    assert got == {(x, y) for x in same for y in same if x < y}
    assert unify_text.same_look_pairs(df.where("false"), "chunk_id", "text").count() == 0


def test_look_alikes_of_more_scripts_and_groups(spark):
    rows = [("a", "COPE"), ("b", "ⲤⲞⲢⲈ"), ("c", "CՕPE"), ("d", "ᏟOᏢE"), ("e", "ꓚꓳꓑꓰ"), ("f", "COPE"), ("g", "cope"), ("h", None), ("i", "  ")]
    df = spark.createDataFrame(rows, "chunk_id string, text string")
    got = {r.id: (r.group_id, r.n_texts) for r in unify_text.same_look_groups(df, "chunk_id", "text").collect()}
    assert got == {i: ("a", 5) for i in "abcdef"} | {"g": ("g", 1)}


def test_unify_keeps_columns_and_nulls(spark):
    df = spark.createDataFrame([(None, 1, "q"), ("x" * 200_000, 2, "q"), ("", 3, "q")], "text string, n int, u string")
    got = {r.n: r.unified for r in unify_text.unify(df).collect()}
    assert got[1] is None and len(got[2]) == 200_000 and got[3] == ""


# sentence_bounds
CASES = [
    ("Dr. Ray ran at 5 p.m. The end.", ["Dr. Ray ran at 5 p.m.", "The end."]),
    ('She wrote, "Go." Then left.', ['She wrote, "Go."', "Then left."]),
    ("The chief said “Stop.” and left the base.", ["The chief said “Stop.” and left the base."]),
    ("It cost 3.5 kg. It\nheld… but fell.", ["It cost 3.5 kg.", "It\nheld… but fell."]),
    ("Main Outputs\n\nDone.", ["Main Outputs", "Done."]),
    ("Annex 7. Test Log\n\nX ran.", ["Annex 7. Test Log", "X ran."]),
    ("Das Ruder, z. B. Nr. 7, hält. Am 7. Oktober prüft Hr. Ott.", ["Das Ruder, z. B. Nr. 7, hält.", "Am 7. Oktober prüft Hr. Ott."]),
    ("“可以！”工程师说。评审说：“好。”速度为7.5节。", ["“可以！”工程师说。", "评审说：“好。”", "速度为7.5节。"]),
    ("「まだ早い！」と答えました。", ["「まだ早い！」と答えました。"]),
    ("โมดูลหนัก 5.5 ตัน ตัวเรือ", ["โมดูลหนัก 5.5 ตัน", "ตัวเรือ"]),
    ("है। ती।", ["है।", "ती।"]),
    ("She said no. Then he left the base.", ["She said no.", "Then he left the base."]),
    ("He studied art. Then he slept. Never mind. Go on. Use a tab. Then type.", ["He studied art.", "Then he slept.", "Never mind.", "Go on.", "Use a tab.", "Then type."]),
    ("Wait 5 sec. Then run. See no. 5, art. IV, App. B and Sec. 2 of it.", ["Wait 5 sec.", "Then run.", "See no. 5, art. IV, App. B and Sec. 2 of it."]),
    ("Col. Smith met Gen. Ott at St. Mary near the col. Then he left.", ["Col. Smith met Gen. Ott at St. Mary near the col.", "Then he left."]),
    ("", []),
    (" \n\n ", []),
]


@pytest.mark.parametrize("page,want", CASES)
def test_sentences(page, want):
    assert [page[a:b] for a, b in sentence_bounds.units(page)] == want


def test_sentence_rows(spark):
    rows = [("d", ["A b. C d.", None, ""], None, "x"), ("d", ["A b. C d.", None, ""], None, "x"), ("e", None, "One.", "x"), ("f", None, None, "x"), (None, ["q."], None, "x")]
    df = spark.createDataFrame(rows, "doc_id string, pages array<string>, text string, body string")
    got = sorted((r.doc_id, r.page, r.char_start, r.char_end) for r in sentence_bounds.sentences(df).collect())
    assert got == [("d", 1, 0, 4), ("d", 1, 5, 9), ("e", 1, 0, 4)]


# corpus_encoding
def test_ids_equal_the_library(spark):
    texts = [None, "", "Hello  world\n\n it's <|endoftext|> 12ab", "é 　  \t x\r\n", "\U0001f468‍\U0001f527 โม ١٢ ²", "a" * 30_000, "the " * 5_000]
    df = spark.createDataFrame([*enumerate(texts), (0, None)], "doc_id bigint, text string").withColumn("ids", F.lit(1))
    tok = corpus_encoding.load()
    enc = corpus_encoding.encode(df)
    got = {r.doc_id: r.ids for r in enc.collect()}
    assert got == {i: tok.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts)}
    assert {r.doc_id: r.text for r in corpus_encoding.decode(enc).collect()} == {i: t or "" for i, t in enumerate(texts)}
    assert corpus_encoding.encode(df.where("false")).count() == 0


# eval_leaks
ITEM = "During exercise Zumbado the tethered flange ring lost 806 degrees after bearing noise reached the hull collar and decoy near Lakebiso station while crews logged 393 watts beside the floating dock"


def test_leaks(spark):
    words = ITEM.split()
    edited = " ".join("xx" if k % 12 == 5 else w for k, w in enumerate(words))
    docs = [(1, "Start. " + ITEM.upper() + " End."), (2, "In front " + edited + " behind"), (3, " ".join(words[:15]) + " [p. 3] noise here " + " ".join(words[15:])), (4, " ".join(words[:6]) + " other text"), (5, None), (6, ""), (7, ITEM.replace("a", "а").replace(" ", " "))]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("words", F.lit("clash"))
    items = spark.createDataFrame([(9, ITEM, "s"), (10, "Which part should be inspected first given panel flutter and icing at the harbor today", "s"), (11, None, "s")], "item_id bigint, text string, suite string")
    got = {(r.doc_id, r.item_id) for r in eval_leaks.leaks(d, items).collect()}
    assert got == {(1, 9), (2, 9), (3, 9), (7, 9)}
    assert eval_leaks.leaks(d.where("false"), items).count() == 0


def test_leaks_of_hot_half_passages(spark):
    items = [(i, " ".join(f"w{i}x{k}" for k in range(40))) for i in range(4)]
    half = " ".join(items[0][1].split()[:20])
    docs = [(n, " ".join(f"d{n}x{k}" for k in range(15)) + (f" {half} " if n % 3 == 0 else " ") + f"end {n} of it") for n in range(300)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in eval_leaks.leaks(d, spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert got == {(n, 0) for n in range(0, 300, 3)}


def leaks_both_ways(spark, docs, items):
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    got = [{(r.doc_id, r.item_id) for r in eval_leaks.leaks(d, i, broadcast_rows=n).collect()} for n in (200_000, 0)]
    assert got[0] == got[1]  # broadcast or shuffled, the same
    return got[0]


def test_leaks_of_passages_that_many_items_share(spark):
    own = [" ".join(f"o{i}x{k}" for k in range(12)) for i in range(6)]
    items = [(i, f"{own[i]} {ITEM}") for i in range(6)] + [(10, ITEM), (11, ITEM.upper() + "!"), *((100 + n, " ".join(f"z{n}y{k}" for k in range(20))) for n in range(60))]
    docs = [(n, f"Here {n} begins {ITEM} and ends") for n in range(40)] + [(99, "nothing of the kind is here at all")]
    assert leaks_both_ways(spark, docs, items) == {(n, i) for n in range(40) for i in (*range(6), 10, 11)}


def test_leaks_of_short_broken_and_unspaced_items(spark):
    words = ITEM.split()
    pieces = " ".join(" ".join(words[k : k + 7]) + f" (note {k}) a b c d e f g" for k in range(0, len(words), 7))
    chinese = "本项目的系留法兰环在演习期间因轴承噪声传到船体套环而失去八百零六度的热量并由船员记录下来"
    items = [(1, "teal gasket hums softly"), (2, ITEM), (3, chinese), (4, "two words")]
    docs = [(1, "It said: Teal gasket hums softly. So be it."), (2, pieces), (3, "前言。" + chinese + "。结束"), (4, "two words stand here"), (5, "a teal gasket"), (6, "系留法兰环"), (7, None)]
    assert leaks_both_ways(spark, docs, items) == {(1, 1), (2, 2), (3, 3)}


# cut_text
def test_slices_of_the_filter_count_alike(spark):
    rows = [(f"k{i}", f"Text {i} tells of {w} and of {x}. It is over" + ("." if i % 3 else "")) for i in range(90) for w, x in [("ships masts winches".split()[i % 3], "harbors cranes".split()[i % 2])]] + [("s", "a"), ("t", "ab")]
    t = spark.createDataFrame(rows, "key string, body string")
    whole = {r.key: round(r.odds, 9) for r in cut_text.log_odds(t).collect()}
    sliced = {r.key: round(r.odds, 9) for r in cut_text.log_odds(t, most_bits=2_000).collect()}
    assert whole == sliced and set(whole) == {k for k, b in rows if len(b) > 1}


def test_cut(spark):
    body = [f"The crew of ship {w} checked the {x} before noon. The {x} was in good order." for w in ("Alda", "Borin", "Cora", "Dena") for x in ("mast", "rudder", "winch", "anchor", "galley")]
    docs = [(i, " ".join(body[i % 20 :] + body[: i % 20]) + ("\nStatus: green" if i % 2 else "")) for i in range(80)]
    cuts = [(100 + i, t[: -25 - i] ) for i, (_, t) in enumerate(docs[:4:2])] + [(110, docs[6][1][:-30] + " [cut]")]
    odd = [(200, None), (201, ""), (202, "  \n"), (0, docs[0][1])]
    df = spark.createDataFrame([(i, t, "s", None if i % 7 == 0 else "en", "clash") for i, t in docs + cuts + odd], "doc_id bigint, text string, source string, lang string, key string")
    got = {r.doc_id for r in cut_text.cut_documents(df).where("is_cut").collect()}
    assert got == {i for i, _ in cuts}
    assert cut_text.cut_documents(df.where("false")).count() == 0


def test_marks():
    assert cut_text.trimmed("earlier claims…") == "earlier claims" and cut_text.trimmed("abc [cut] ") == "abc" and cut_text.trimmed("done.") == "done."
    assert cut_text.trimmed("see (note)") == "see (note)"


# scan_repair
def test_scan_repair(spark):
    head = "Barensalen Trial Report"
    text = "The concept uses a prototype junction to allow mine clearance with reduced cost. The long-endurance design keeps the keel above the surface. Spare parts arrive every day."
    plain = [(f"n{i}", None, None, text, "native") for i in range(30)]
    pages = [f"{head} | 1\n\nThe concept uses a prototype junction to allow mine clearance with redu-\nced c0st. The long-\nendurance design keeps tbe keel above the sur-", f"{head} | 2\nface. Spare parts arrive every day."]
    scans = [("s", pages, None, None, "ocr"), ("s", pages, None, None, "ocr"), ("t", None, None, None, "ocr"), ("u", [None, ""], None, None, "ocr")]
    d = spark.createDataFrame([(i, p, t, x) for i, p, _, t, x in plain + scans], "doc_id string, pages array<string>, text string, extractor string")
    e = spark.createDataFrame([("e1", "f", 1, "Text", "Spare parts ar1ive", (3, None), "ocr"), ("e2", "f", 2, "Text", None, (3, None), "ocr")], "element_id string, filename string, ord int, type string, text string, metadata struct<page_number:int,text_as_html:string>, extractor string")
    got = {tuple(r) for r in scan_repair.repairs(d, e).collect()}
    assert {("s", 1, 1, "furniture", ""), ("s", 2, 1, "furniture", ""), ("s", 1, 3, "joined", "reduced"), ("s", 1, 4, "misread", "cost"), ("s", 1, 4, "joined", "long-endurance"), ("s", 1, 5, "misread", "the"), ("s", 1, 5, "joined", "surface")} <= got
    para = {(r.record_id, r.page, r.para): r.text for r in scan_repair.paragraphs(d, e).collect()}
    assert para == {("s", 1, 0): text, ("e1", 3, 0): "Spare parts ar1ive"}  # no confusion makes "arrive" of that
    assert scan_repair.paragraphs(d.where("false"), e.where("false")).count() == 0


def test_many_misread_titles_and_headers_of_two_lines():
    titles = [f"{a} {b} Report" for a in ("Alden", "Borin", "Cedric", "Dorvan") for b in ("Harbor", "Winter", "Signal")]
    body = lambda n: f"the crew of {n * 7919 % 1000 / 7:.6f} went on with the work\nand {'zyxwvuts'[n % 8] * (n + 3)} slept for the night"
    pages = [(n + 1, f"{t}\nProgram Office Review Copy\n\n{body(n)}\n\n{n + 1}") for n, t in enumerate(titles * 2)]
    pages += [(100 + n, f"{t[:-3]}0rt\nProgram Office Revicw Copy\n\n{body(n + 30)}") for n, t in enumerate(titles)]
    sy = scan_repair.symbols(pages, None)
    first = {(i, k): s for i, k, _, s in sy if k <= 2}
    assert len(titles) > 8 and all(s.startswith("T") and "r" in s[2:] for s in first.values())
    assert all(s[0] == "M" for _, k, x, s in sy if k == 4)


def test_words_with_accents_are_repaired(spark):
    native = [(f"n{i}", ["Das Gerät hält die Größe der Übung ein."], "native") for i in range(5)]
    d = spark.createDataFrame([*native, ("s", ["Es hä1t am Ort"], "ocr")], "doc_id string, pages array<string>, extractor string").withColumn("text", F.lit(None).cast("string"))
    e = spark.createDataFrame([], "element_id string, filename string, ord int, type string, text string, metadata struct<page_number:int,text_as_html:string>, extractor string")
    assert {(r.kind, r.repaired) for r in scan_repair.repairs(d, e).collect()} == {("misread", "hält")}
    assert [r.text for r in scan_repair.paragraphs(d, e).collect()] == ["Es hält am Ort"]


def test_viterbi_prefers_the_likelier_path():
    model = {"emit": {("header", "x"): math.log(0.9), ("body", "x"): math.log(0.1)}, "trans": {("start", "header"): math.log(0.5), ("start", "body"): math.log(0.5)}, "unseen": [-5.0, -5.0, -5.0]}
    assert scan_repair.viterbi(["x"], model) == ["header"]


def test_misread_running_titles_of_slides_repeat(spark):
    d = spark.createDataFrame([], "doc_id string, extractor string, pages array<string>, text string")
    rows = [("a", 1, "SENFUNINI QUAD CHART"), ("b", 2, "SENFUNlNI QUAD CHART"), ("c", 3, "SENFUNINI QUAD CHART\nthe first results are in"), ("d", 4, "Harbor Crane Review"), ("e", 4, "Harbor Crane Reviow")]
    e = spark.createDataFrame([(i, "f.pdf", "ocr", t, (n,)) for i, n, t in rows], "element_id string, filename string, extractor string, text string, metadata struct<page_number:int>")
    got = {r.rec: (r.pages, r.rep) for r in scan_repair.scanned(d, e).collect()}
    sy = {i: [x[3] for x in scan_repair.symbols([(p["page"], p["body"]) for p in pages], rep)] for i, (pages, rep) in got.items()}
    assert sy == {"a": ["Sncr"], "b": ["Sncr"], "c": ["Tncr", "Enl-"], "d": ["Snc-"], "e": ["Snc-"]}
