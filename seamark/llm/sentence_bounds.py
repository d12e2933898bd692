"""Sentence boundaries across languages and scripts (problem 4).

The standard character-property rules for sentence breaks, tailored: terminators of all scripts
(``Sentence_Break`` STerm and ATerm) with their closing marks; a full stop between digits or
letters, before a lower-case word or after an abbreviation of the page's language ends nothing;
speech quoted inside a longer sentence does not end it; blank lines end every unit, single line
breaks none; in a script that writes no stops (Thai, Lao, Khmer and the like, when a paragraph
has none) the blank ends the unit. A short line set off by blank lines is a heading, one unit.

Pages are independent rows, so the operator is one narrow map inside Arrow batches.

Defined results: null and empty pages and documents without pages give no unit; where ``pages``
is null, ``text`` is page 1; a repeated doc_id counts once; offsets count code points.
"""

from __future__ import annotations

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Abbreviations that a name, number or further word follows, by language.
BEFORE_NAME = {
    "en": "dr mr mrs ms prof gen col capt lt maj sgt cdr adm rev hon gov sen rep pres st mt messrs sec fig figs app vol no nos pp p pg ch art eq ref dept approx ca cf vs e.g i.e viz al para par tab ver v nr",
    "de": "dr hr fr frau prof ing dipl nr abb tab bd kap abs art s ca bzw vgl z.b d.h u.a o.ä i.d.r m.e ggf evtl inkl zzgl st str tel hrsg geb usw.o sog max min mind",
    "fr": "m mm mme mmes mlle dr me pr prof st ste fig p pp art chap vol no n env av cf ex éd p.ex c.-à-d h r.-v",
    "es": "sr sra sres srta dr dra d dña ing lic prof gral cap tte pág págs p art núm fig cap vol aprox av c ej p.ej ee tel ud uds n.º",
    "ru": "г гг см рис стр т.е т.к т.д т.п др проф акад им ул д кв тыс млн млрд руб коп ок п пп гл табл напр т ср",
    "it": "sig sigg dott dr prof ing avv pag fig art ecc es cap n",
    "pt": "sr sra dr dra prof eng pág fig art núm av aprox ex",
    "nl": "dhr mevr dr prof ir ing nr blz bijv d.w.z o.a art fig ca",
}
# Abbreviations that are words as well, or words of another language. Before a number or
# label they are abbreviations, and the titles among them before a name; else they close a sentence as any word does.
WORDS_TOO = set("no nos art app ch sec tab par para ver mind cap max min abs str sog col st gen rep rev sen pres hon".split())
TITLES_TOO = set("col st gen rep rev sen pres hon sec".split())
# Abbreviations that also close a sentence when a capital follows.
MAY_END = set("etc inc ltd co corp llc jr sr a.m p.m u.s u.k u.n e.u kg km cm mm usw etc. ecc dgl и.т.д т.д т.п др г кг км ud uds ag gmbh".split())
MONTHS = set(
    """januar februar märz april mai juni juli august september oktober november dezember jänner""".split()
)
OPEN, CLOSE = "\"'“‘«„‚「『（(《〈【[‹", "\"'”’»“」』）)》〉】]›"
NO_STOP_SCRIPTS = regex.compile(r"[\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tai_Tham}]")
STOP = regex.compile(r"(?:\p{Sentence_Break=STerm}|\p{Sentence_Break=ATerm}|…)+[\p{Sentence_Break=STerm}\p{Sentence_Break=ATerm}…]*")
WIDE = set("。！？｡．")
PARA = regex.compile(r"(?:\r\n?|\n)[^\S\r\n]*(?:\r\n?|\n)\s*|\u2029\s*|\f\s*")
WORD_BEFORE = regex.compile(r"[\p{L}\p{M}\p{N}][\p{L}\p{M}\p{N}.\-­'’]*$")
CJK = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}ー]")
FRENCH_CLOSE = regex.compile(r"\s»")
THAI_BLANK = regex.compile(r"(?<![\d.,:;ๆ])[^\S\r\n]+(?![\dๆ])")
LABEL = regex.compile(r"[B-HJ-Z](?![\w.'’])|[AI](?=[,;:)\]])|[IVXLC]{2,}\b")  # of a section, figure or annex
LATIN_MARKS = {
    "de": regex.compile(r"\b(?:der|die|das|und|ist|mit|den|im|ohne|wer|vor|bei)\b", regex.I),
    "fr": regex.compile(r"\b(?:le|la|les|des|et|avec|est|une|du|près|pendant)\b", regex.I),
    "es": regex.compile(r"\b(?:el|la|los|las|del|con|una|por|sin|durante|y)\b", regex.I),
    "it": regex.compile(r"\b(?:il|gli|della|con|per|una|che|di)\b", regex.I),
    "pt": regex.compile(r"\b(?:os|uma|com|para|não|da|do|em)\b", regex.I),
    "nl": regex.compile(r"\b(?:het|een|van|met|voor|niet|de)\b", regex.I),
    "en": regex.compile(r"\b(?:the|and|of|with|for|from|was|is|to)\b", regex.I),
}
_SETS = {k: set(v.split()) for k, v in BEFORE_NAME.items()}
# Abbreviations that are no word elsewhere hold in every language: pages mix languages within a line.
_COMMON = {w for v in _SETS.values() for w in v if len(w) >= 3} - {"eng", "usw.o", "kap"} | _SETS["en"]


def language(paragraph: str) -> str:
    """The likeliest language of a paragraph by script and small words."""
    if regex.search(r"\p{Cyrillic}{3}", paragraph):
        return "ru"
    scores = {k: len(r.findall(paragraph)) for k, r in LATIN_MARKS.items()}
    best = max(scores, key=lambda k: scores[k])
    return best if scores[best] else "en"


def _open_quote(text: str, start: int, end: int) -> int:
    """Where the quotation that closes at ``end`` opened in this unit; -1 if none did."""
    pairs = {"”": "“„", "’": "‘‚", "»": "«", "」": "「", "』": "『", "）": "（", ")": "(", "》": "《", "]": "[", "“": "„", "«": "»"}
    c = text[end - 1]
    if c in "\"'":
        at = text.rfind(c, start, end - 1)
        return at
    for o in pairs.get(c, ""):
        at = text.rfind(o, start, end - 1)
        if at >= 0:
            return at
    return -1


def _ends(text: str, unit: int, dot: int, after_stop: int, after_close: int, limit: int, lang: str) -> bool:
    """Whether the terminators at ``dot``..``after_stop``, closed by ``after_close``, end the unit begun at ``unit``."""
    stop = text[dot:after_stop]
    closers = text[after_stop:after_close]
    nxt = after_close
    while nxt < limit and text[nxt].isspace():
        nxt += 1
    if nxt >= limit:
        return True
    gap = nxt > after_close
    follow = text[nxt]
    bare = nxt
    while bare < limit and text[bare] in OPEN:
        bare += 1
    head = text[bare] if bare < limit else follow
    quoted = any(c in CLOSE and c not in ")）]】" for c in closers)
    if stop[0] in WIDE or (not gap and CJK.match(follow)):
        if set(stop) <= set("….．.") and not gap:
            return False  # an ellipsis or number inside a sentence of a script without blanks
        if any(c in ")）]】" for c in closers) and not quoted:
            at = _open_quote(text, unit, after_close)
            return at >= 0 and not text[unit:at].strip()  # an aside in brackets does not end its sentence
        if quoted:
            if regex.match(r"[とってのはがをにもへで、，,，;；:：]", follow):
                return False
            at = _open_quote(text, unit, after_close)
            # Speech that opens its sentence is followed by who said it; speech after a colon or verb closes it.
            return bool(at >= 0 and text[unit:at].strip()) or gap or follow in OPEN
        return True
    only_dots = set(stop) <= set(".․﹒．…")
    if not gap and not closers:
        return not only_dots and head.isupper()
    if not gap and closers:
        return False
    # A lower-case word, or a mark that goes on with the sentence, follows.
    if head.islower() or follow in ",;:–—-" or follow in ")]":
        return False
    if not only_dots:
        return True
    if "…" in stop or len(stop) >= 3:
        return not head.islower()
    m = WORD_BEFORE.search(text, unit, dot)
    word = m.group(0).lower().strip(".-'’") if m else ""
    if dot > unit and text[dot - 1].isspace():
        return not head.isdigit()
    raw = m.group(0) if m else ""
    if not word or closers:
        return True
    known = _SETS.get(lang, set()) | _COMMON
    word = word.rsplit("’", 1)[-1].rsplit("'", 1)[-1]
    if text[dot - 1] in "°º":
        return not head.isdigit()
    if word in MAY_END and word not in _SETS.get(lang, set()):
        return True
    # Two-part abbreviations such as "z. B." or "т. е." carry their first part before a blank.
    pair = regex.search(r"(\p{L})\.[\s ]*$", text[max(unit, m.start() - 4) : m.start()]) if m and len(word) == 1 else None
    if pair and word.isalpha():
        joined = f"{pair.group(1).lower()}.{word}"
        if joined in MAY_END:
            return True
        if joined in known:
            return False
    if word in ("г", "гг") and regex.search(r"\d\s*$", text[max(unit, m.start() - 3) : m.start()]):
        return True  # after a year it is a year's end, not a town
    if word in known:
        if word not in WORDS_TOO or head.isdigit():
            return False
        return not (word in TITLES_TOO and raw[:1].isupper() and head.isupper()) and not LABEL.match(text, bare, limit)
    if len(raw) == 1 and raw.isalpha() and not raw.islower():
        return False  # an initial, or a one-letter title of a script without cases
    if len(raw) == 1 and regex.match(r"\p{L}\.", text[nxt : nxt + 2]):
        return False  # the first part of "z. B."
    if regex.fullmatch(r"(?:\p{L}\.)+\p{L}", raw):
        return word in MAY_END
    if raw.isdigit() and lang == "de":
        nxt_word = regex.match(r"\p{L}+", text[nxt : nxt + 20])
        if nxt_word and nxt_word.group(0).lower() in MONTHS:
            return False
    return True


def _heading(text: str) -> bool:
    """A short single line without a stop at its end."""
    t = text.strip()
    return len(t) <= 80 and "\n" not in t and "\r" not in t and not regex.search(r"[.!?。！？؟।…][\"'”’»」』)\]]*$", t) and not NO_STOP_SCRIPTS.search(t)


def units(page: str) -> list[tuple[int, int]]:
    """Start and end of every sentence unit of a page, without outer blanks."""
    out: list[tuple[int, int]] = []
    cuts = [(m.start(), m.end()) for m in PARA.finditer(page)]
    begin = 0
    for a, b in [*cuts, (len(page), len(page))]:
        _paragraph(page, begin, a, out)
        begin = b
    return out


def _add(page: str, a: int, b: int, out: list[tuple[int, int]]) -> None:
    while a < b and page[a].isspace():
        a += 1
    while b > a and page[b - 1].isspace():
        b -= 1
    if b > a:
        out.append((a, b))


def _paragraph(page: str, a: int, b: int, out: list[tuple[int, int]]) -> None:
    body = page[a:b]
    if not body.strip():
        return
    if _heading(body):
        _add(page, a, b, out)
        return
    if NO_STOP_SCRIPTS.search(body) and not any(m.end() == b or page[m.end()].isspace() for m in STOP.finditer(page, a, b)):
        at = a
        for m in THAI_BLANK.finditer(page, a, b):
            _add(page, at, m.start(), out)
            at = m.end()
        _add(page, at, b, out)
        return
    lang = language(body)
    unit, pos = a, a
    while unit < b and page[unit].isspace():
        unit += 1
    for m in STOP.finditer(page, a, b):
        if m.start() < pos:
            continue
        end = m.end()
        while end < b and page[end] in CLOSE:
            if page[end] == "“" and "„" not in page[unit:end]:
                break  # outside German it opens the next speech
            if page[end] in "\"'" and end + 1 < b and page[end + 1].isalnum():
                break
            end += 1
        stands_off = FRENCH_CLOSE.match(page, m.end(), b)
        if stands_off and "«" in page[unit : m.start()]:
            end = stands_off.end()  # French closing marks stand off by a blank
        if _ends(page, unit, m.start(), m.end(), end, b, lang):
            _add(page, unit, end, out)
            unit = end
            while unit < b and page[unit].isspace():
                unit += 1
        pos = end
    _add(page, unit, b, out)


def page_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, page, body`` of documents (``doc_id, pages, text``); repeated ids count once."""
    d = docs.select("doc_id", F.coalesce("pages", F.array("text")).alias("pages")).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = d.select("doc_id", F.posexplode("pages").alias("p", "body"))
    return rows.where("body IS NOT NULL AND body <> ''").select("doc_id", (F.col("p") + 1).alias("page"), "body")


def sentences(docs: DataFrame) -> DataFrame:
    """``doc_id, page, char_start, char_end, text`` of every sentence unit."""

    def run(batches):
        for b in batches:
            doc, page, at, to, txt = [], [], [], [], []
            for d, p, body in zip(b.column("doc_id").to_pylist(), b.column("page").to_pylist(), b.column("body").to_pylist(), strict=True):
                for x, y in units(body):
                    doc.append(d)
                    page.append(p)
                    at.append(x)
                    to.append(y)
                    txt.append(body[x:y])
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.string()), pa.array(page, pa.int32()), pa.array(at, pa.int32()), pa.array(to, pa.int32()), pa.array(txt, pa.string())], names=["doc_id", "page", "char_start", "char_end", "text"])

    return page_rows(docs).mapInArrow(run, "doc_id string, page int, char_start int, char_end int, text string")
