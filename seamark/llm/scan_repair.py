"""Continuous text from scanned pages (problem 2).

Lines are labelled by a hidden Markov model with the states header (running headers, footers,
page numbers), body and break. Its symbols are layout features of a line: place on the page, page
number pattern and whether it is this page's number, title case, repetition on other pages. Start
labels come from the strongest features; transition and emission counts are then taken over the
whole corpus in Spark (hard EM, ``ROUNDS`` rounds) and every record is decoded with Viterbi.

Words broken at line ends are joined over blank lines, headers and pages, keeping a hyphen where
the corpus writes one; misrecognised characters are undone by a noisy channel of typical
confusions against the corpus vocabulary. Distinct tokens are corrected once and joined back;
hot tokens are broadcast (fewer than 2,048 of them). ``paragraphs`` reassembles the repaired text.

Defined results: null or empty pages and texts give no repair; where ``pages`` is null, ``text``
is page 1; repeated ids count once; lines split at LF, a CR before it is no part of the line.
"""

from __future__ import annotations

import math
import re
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamark.functions.dist import cut, lookup_join, n_partitions
from seamark.llm.name_parts import osa, segment_keys

STATES = ("header", "body", "break")
ROUNDS = 2
# What scanners read for a letter, and the letter.
SIGNS = {"0": "o", "1": "l", "5": "s", "6": "b", "9": "g", "8": "b", "4": "a", "7": "t", "3": "e", "@": "a", "!": "i", "(": "c", "+": "t", "|": "l", "$": "s", "{": "c", "&": "a"}
LETTERS = [("c", "e"), ("ii", "u"), ("ri", "n"), ("cl", "d"), ("rn", "m"), ("vv", "w"), ("b", "h"), ("y", "v"), ("i", "t"), ("n", "rt"), ("m", "rn"), ("d", "cl"), ("h", "b"), ("l", "i"), ("i", "l"), ("e", "c"), ("u", "n"), ("n", "u"), ("f", "t"), ("t", "f"), ("o", "a"), ("a", "o"), ("v", "y"), ("li", "h"), ("lc", "k"), ("w", "vv"), ("u", "ii"), ("t", "i")]
HYPHENS = "-­‐‑¬"
ROMAN = {r: i for i, r in enumerate("i ii iii iv v vi vii viii ix x xi xii xiii xiv xv xvi xvii xviii xix xx".split(), 1)}
NUMBER = r"(?:page\s+)?(?:p\.\s*)?[\[(~–—-]?\s*(\d{1,5}|[ivx]{1,6})\s*(?:(?:/|of)\s*\d{1,5})?\s*[\])~–—-]?"
ALONE = re.compile(rf"^{NUMBER}$", re.I)
BEFORE = re.compile(rf"^{NUMBER}(?:\s{{2,}}|\s*\|\s*)(?P<t>[^\d\s].*)$", re.I)
AFTER = re.compile(rf"^(?P<t>.*[^\s|])(?:\s{{2,}}|\s*\|\s*){NUMBER}$", re.I)


def _value(s: str) -> int:
    return int(s) if s.isdigit() else ROMAN.get(s.lower(), -1)


def signature(line: str) -> str:
    """A line's letters with confusable ones made equal, without its page number."""
    for r in (BEFORE, AFTER):
        m = r.match(line.strip())
        if m:
            line = m.group("t")
            break
    s = line.lower()
    for a, b in SIGNS.items():
        s = s.replace(a, b)
    s = re.sub(r"[^a-z]", "", s)
    for a, b in (("rn", "m"), ("ri", "n"), ("cl", "d"), ("ii", "u"), ("vv", "w"), ("h", "b"), ("v", "y"), ("e", "c"), ("t", "i")):
        s = s.replace(a, b)
    return s


def titled(line: str) -> bool:
    words = [w for w in re.split(r"[\s|]+", line) if re.search(r"[A-Za-z]{2}", w)]
    return 2 <= len(words) <= 8 and len(line) < 80 and all(w[0].isupper() or w[0].isdigit() or w[0] in SIGNS for w in words) and line.strip()[-1:] not in ".;:,"


def lines_of(body: str) -> list[str]:
    return [x[:-1] if x.endswith("\r") else x for x in body.split("\n")]


class Nearly:
    """Strings to be found again within 2 edits, by their segments."""

    def __init__(self, known: list[str]):
        self.by: dict[str, list[str]] = {}
        for s in known:
            for keys in segment_keys(s, lambda n: 2, 2):
                for k in keys:
                    self.by.setdefault(k, []).append(s)

    def __contains__(self, s: str) -> bool:
        tried = set()
        for keys in segment_keys(s, lambda n: 2, 2):
            for k in keys:
                for o in self.by.get(k, ()):
                    if o not in tried:
                        tried.add(o)
                        if osa(o, s, 2) <= 2:
                            return True
        return False


def symbols(pages: list[tuple[int | None, str]], repeated: list[str] | None) -> list[tuple[int, int, str, str]]:
    """``page index, line number, line, symbol`` for every line of a record.

    ``repeated`` has for a slide element the signatures of its lines that return on other pages of its
    file; for a document (None) that is found out from its own pages."""
    split = [lines_of(b or "") for _, b in pages]
    signs = [[signature(x) if x.strip() else "" for x in ls] for ls in split]
    seen: dict[str, int] = {}
    if repeated is None:
        for ls, ss in zip(split, signs, strict=True):
            full = [k for k, x in enumerate(ls) if x.strip()]
            for s in {ss[k] for k in _edges(ls, full) if len(ls[k]) < 90}:
                seen[s] = seen.get(s, 0) + 1
        often = {s for s, n in seen.items() if n > 1 and len(s) > 5}
        nearly = Nearly(sorted(often))
    else:
        often, nearly = set(repeated), ()
    out = []
    for i, (ls, ss) in enumerate(zip(split, signs, strict=True)):
        page = pages[i][0]
        full = [k for k, x in enumerate(ls) if x.strip()]
        marks, again, same = {}, {}, {}
        for k in full:
            t = ls[k].strip()
            num, value = "n", None
            if (m := ALONE.match(t)) and _value(m.group(1)) > 0:
                num, value = "a", _value(m.group(1))
            elif (m := BEFORE.match(t) or AFTER.match(t)) and titled(m.group("t")) and _value(m.group(1)) > 0:
                num, value = "b", _value(m.group(1))
            marks[k] = num
            same[k] = "=" if value is not None and page is not None and value == page else "~" if value is not None else ""

        def returns(k, ls=ls, ss=ss, again=again):
            if k not in again:
                again[k] = len(ls[k].strip()) <= 90 and (ss[k] in often or (repeated is None and ss[k] in nearly))
            return again[k]

        # From either side the edge goes on over lines that return, or carry this page's number.
        edge = {}
        for name, order in (("T", full), ("E", full[::-1])):
            for n, k in enumerate(order):
                if n and (k in edge or not (returns(k) or same[k] == "=") or not (returns(order[n - 1]) or same[order[n - 1]] == "=")):
                    break
                edge.setdefault(k, name)
        for k, x in enumerate(ls):
            t = x.strip()
            if not t:
                out.append((i, k + 1, x, "blank"))
                continue
            place = "S" if len(full) == 1 else edge.get(k, "M")
            plainly = "w" if not re.search(r"[A-Za-z]", t) or re.fullmatch(r"\d+", t) else ""
            out.append((i, k + 1, x, f"{place}{marks[k]}{same[k]}{'c' if titled(t) else 'l'}{'r' if place != 'M' and returns(k) else '-'}{plainly}"))
    return out


def _edges(lines: list[str], full: list[int]) -> list[int]:
    """Lines that could stand in a header or footer: from either end, short ones up to the first that is not."""
    out = []
    for order in (full, full[::-1]):
        for n, k in enumerate(order):
            if n > 1 and not titled(lines[k].strip()):
                break
            out.append(k)
    return out


def first_guess(symbol: str) -> str:
    """The start label: a title with the page's number, a repeated title, or the page's number alone, at an edge."""
    if symbol == "blank":
        return "break"
    if symbol[0] == "M":
        return "body"
    if symbol[1] == "b" or (symbol[1] == "a" and ("=" in symbol or "r" in symbol[2:])):
        return "header"
    return "header" if symbol[1] == "n" and "c" in symbol[2:] and "r" in symbol[2:] else "body"


def viterbi(seq: list[str], model: dict) -> list[str]:
    n = len(STATES)
    unseen = model["unseen"]
    emit = lambda s, k: model["emit"].get((STATES[k], s), unseen[k])
    score = [model["trans"].get(("start", STATES[k]), -9.0) + emit(seq[0], k) for k in range(n)]
    back = []
    for s in seq[1:]:
        step, new = [], []
        for k in range(n):
            best = max(range(n), key=lambda j: score[j] + model["trans"].get((STATES[j], STATES[k]), -9.0))
            step.append(best)
            new.append(score[best] + model["trans"].get((STATES[best], STATES[k]), -9.0) + emit(s, k))
        back.append(step)
        score = new
    k = max(range(n), key=lambda j: score[j])
    out = [k]
    for step in reversed(back):
        k = step[k]
        out.append(k)
    return [STATES[k] for k in reversed(out)]


def scanned(docs: DataFrame, elements: DataFrame) -> DataFrame:
    """``rec, pages, rep``: scanned documents and slide elements as records of pages."""
    d = docs.where("extractor = 'ocr' AND doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    body = F.coalesce("pages", F.array("text"))
    d = d.select(F.col("doc_id").alias("rec"), F.transform(body, lambda x, i: F.struct((i + 1).cast("int").alias("page"), x.alias("body"))).alias("pages"), F.lit(None).cast("array<string>").alias("rep"))
    e = elements.where("extractor = 'ocr' AND element_id IS NOT NULL AND text IS NOT NULL").dropDuplicates(["element_id"]).select("element_id", "filename", "text", F.col("metadata.page_number").alias("page"))

    def sign(batches):
        for b in batches:
            at, sigs, keys, waits = [], [], [], []
            for i, text in enumerate(b.column("text").to_pylist()):
                full = [x.strip() for x in lines_of(text) if x.strip()]
                for x in dict.fromkeys(full[k] for k in _edges(full, list(range(len(full))))):
                    if len(x) < 90 and (titled(x) or BEFORE.match(x) or AFTER.match(x)) and len(g := signature(x)) > 5:
                        for w, ks in zip((True, False), segment_keys(g, lambda n: 2, 2), strict=True):
                            at += [i] * len(ks)
                            sigs += [g] * len(ks)
                            keys += ks
                            waits += [w] * len(ks)
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(at, pa.int64())) for c in ("element_id", "filename", "page")), pa.array(sigs, pa.string()), pa.array(keys, pa.string()), pa.array(waits, pa.bool_())], names=["element_id", "filename", "page", "sig", "part", "waits"])

    sig = cut(e.select("element_id", "filename", F.col("page").cast("int").alias("page"), "text").mapInArrow(sign, "element_id string, filename string, page int, sig string, part string, waits boolean"))
    # A title returns when another page of the file has it within 2 edits; titles of a file meet by their segments.
    each = sig.where("page IS NOT NULL").groupBy("filename", "sig", "part", "waits").agg(F.min("page").alias("lo"), F.max("page").alias("hi"))
    one = each.where("waits").select("filename", "part", "sig", "lo", "hi")
    other = each.where("NOT waits").select("filename", "part", F.col("sig").alias("sig2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    near = one.join(other, ["filename", "part"]).where((F.least("lo", "lo2") < F.greatest("hi", "hi2")) & (F.levenshtein("sig", "sig2", 2) >= 0))
    near = near.select("filename", F.explode(F.array("sig", "sig2")).alias("sig"))
    sig = sig.select("element_id", "filename", "sig").distinct()
    rep = sig.join(near.distinct(), ["filename", "sig"]).groupBy("element_id").agg(F.collect_set("sig").alias("rep"))
    e = e.join(rep, "element_id", "left").select(F.col("element_id").alias("rec"), F.array(F.struct(F.col("page").cast("int").alias("page"), F.col("text").alias("body"))).alias("pages"), F.coalesce("rep", F.expr("cast(array() as array<string>)")).alias("rep"))
    return d.unionByName(e)


def featured(records: DataFrame) -> DataFrame:
    """``rec, lines, syms``: the lines of each record (page, number, text) and their symbols."""

    def run(batches):
        for b in batches:
            rec, lines, syms = [], [], []
            for r in b.to_pylist():
                pages = [(p["page"], p["body"]) for p in r["pages"] or []]
                sy = symbols(pages, r["rep"])
                rec.append(r["rec"])
                lines.append([{"i": i, "page": pages[i][0], "k": k, "x": x} for i, k, x, _ in sy])
                syms.append([s for *_, s in sy])
            kind = pa.struct([("i", pa.int32()), ("page", pa.int32()), ("k", pa.int32()), ("x", pa.string())])
            yield pa.RecordBatch.from_arrays([pa.array(rec, pa.string()), pa.array(lines, pa.list_(kind)), pa.array(syms, pa.list_(pa.string()))], names=["rec", "lines", "syms"])

    return records.mapInArrow(run, "rec string, lines array<struct<i:int,page:int,k:int,x:string>>, syms array<string>")


def train(features: DataFrame, rounds: int = ROUNDS) -> dict:
    """Transition and emission log probabilities, counted over all lines of all records. The model has
    a fixed size: three states and the symbols the features can form."""
    model = None
    for _ in range(rounds):
        now = model

        def count(batches, now=now):
            total: dict = {}
            for b in batches:
                for seq in b.column("syms").to_pylist():
                    labels = ([first_guess(s) for s in seq] if now is None else viterbi(seq, now)) if seq else []
                    prev = "start"
                    for s, y in zip(seq, labels, strict=True):
                        total["e", y, s] = total.get(("e", y, s), 0) + 1
                        total["t", prev, y] = total.get(("t", prev, y), 0) + 1
                        prev = y
            if total:
                yield pa.RecordBatch.from_arrays([*(pa.array([k[i] for k in total], pa.string()) for i in range(3)), pa.array(list(total.values()), pa.int64())], names=["what", "x", "y", "n"])

        got = features.select("syms").mapInArrow(count, "what string, x string, y string, n bigint").groupBy("what", "x", "y").agg(F.sum("n").alias("n")).collect()
        emit, trans = {}, {}
        size = {s: sum(r["n"] for r in got if r["what"] == "e" and r["x"] == s) for s in STATES}
        for r in got:
            if r["what"] == "e":
                emit[r["x"], r["y"]] = math.log((r["n"] + 0.1) / (size[r["x"]] + 10))
            else:
                trans[r["x"], r["y"]] = math.log((r["n"] + 1) / (sum(q["n"] for q in got if q["what"] == "t" and q["x"] == r["x"]) + 3))
        model = {"emit": emit, "trans": trans, "unseen": [math.log(0.1 / (size[s] + 10)) for s in STATES]}
    return model or {"emit": {}, "trans": {}, "unseen": [-9.0, -1.0, -9.0]}


SIGN_CLASS = "".join(re.escape(c) for c in SIGNS if not c.isdigit())
INNER = re.compile(r"[a-z]['’]?[a-z]|[a-z]", re.I)


def core(token: str) -> str:
    """A word in lower case without outer punctuation; signs that scanners put for letters stay."""
    return re.sub(rf"^[^\w{SIGN_CLASS}]+|[^\w{SIGN_CLASS}]+$", "", token).strip("_").lower()


def bare(token: str) -> str:
    return re.sub(r"^[\W_]+|[\W_]+$", "", token).lower()


def broken_at(line: str, after: str | None) -> tuple[str, str, bool] | None:
    """Of a word broken at the end of ``line``: its first part, its second one, whether the hyphen is close."""
    tokens, t = line.split(), line.rstrip(" \t")
    if after is None or not t or t[-1] not in HYPHENS:
        return None
    tight = len(t) > 1 and not t[-2].isspace()
    nxt = after.split()
    left = tokens[-1][:-1] if tight else tokens[-2] if len(tokens) > 1 else ""
    if left and nxt and re.search(r"[^\W\d]$|[^\W\d][\d@!(+]$", left) and re.match(r"\w|[@!(+]", nxt[0]):
        return left, nxt[0], tight
    return None


def repairs_of(lines: list[dict], labels: list[str]) -> list[tuple]:
    """``page, line, kind, token, first, second``: furniture, words broken at line ends, and plain tokens."""
    out = []
    text = [(r["page"], r["k"], r["x"]) for r, y in zip(lines, labels, strict=True) if y == "body" and r["x"].strip()]
    for r, y in zip(lines, labels, strict=True):
        if y == "header" and r["x"].strip():
            out.append((r["page"], r["k"], "furniture", "", "", ""))
    skip: set[int] = set()
    for n, (page, k, x) in enumerate(text):
        tokens = x.split()
        broken = broken_at(x, text[n + 1][2] if n + 1 < len(text) else None)
        inner = tokens[1:] if n in skip else tokens
        if broken:
            left, right, tight = broken
            out.append((page, k, "tight" if tight else "loose", "", left, right))
            inner = inner[: -1 if tight else -2] if len(inner) >= (1 if tight else 2) else []
            skip.add(n + 1)
        for w in inner:
            out.append((page, k, "word", w, "", ""))
    return [r for r in out if r[2] != "word" or re.search(r"[^\W\d_]", r[3])]


def candidates(word: str) -> list[tuple[str, int]]:
    """Words that scanners could have read as ``word``, with the number of changes."""
    found: dict[str, int] = {}
    plainly = "".join(SIGNS.get(c, c) for c in word)
    base = [(word, 0)] if plainly == word else [(plainly, 1)]
    for w, n in base:
        if n:
            found.setdefault(w, n)
        for a, b in LETTERS:
            at = w.find(a)
            while at >= 0:
                one = w[:at] + b + w[at + len(a) :]
                found.setdefault(one, n + 1)
                at = w.find(a, at + 1)
    return [(w, n) for w, n in found.items() if w != word and re.fullmatch(r"[^\W\d_]+(?:[-'’][^\W\d_]+)*", w)]


def vocabulary(texts: DataFrame) -> DataFrame:
    """``word, n`` over all texts (``body``): words of letters with inner hyphens."""
    words = F.regexp_extract_all(F.lower("body"), F.lit(r"(?<![^\s\"'“”(\[])\p{L}{2,}(?:-\p{L}+)*(?=[\s.,;:!?\"'”)\]]|$)"), F.lit(0))
    return texts.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def corrections(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """``token, right``: distinct tokens (``token``) that are misread, and the words they stand for."""

    def run(batches):
        for b in batches:
            tok, key, cand, cost = [], [], [], []
            for t in b.column("token").to_pylist():
                c, p = core(t), bare(t)
                odd = bool(re.search(rf"[{SIGN_CLASS}\d]", c)) and bool(re.search(r"[a-z]", c))
                if sum(ch.isdigit() for ch in c) > 0.5 * len(c) or len(c) < 3:
                    continue
                for w, n in candidates(c):
                    tok.append(t)
                    key.append(p if not (odd and re.search(rf"[{SIGN_CLASS}\d]", p)) else "")
                    cand.append(w)
                    cost.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(tok, pa.string()), pa.array(key, pa.string()), pa.array(cand, pa.string()), pa.array(cost, pa.int32())], names=["token", "own", "word", "cost"])

    c = tokens.repartition(n_partitions(tokens)).mapInArrow(run, "token string, own string, word string, cost int")
    c = c.join(vocab, "word")
    best = c.groupBy("token", "own").agg(F.max_by("word", F.struct(-F.col("cost"), "n", "word")).alias("right"), F.max(F.struct(-F.col("cost"), "n"))["n"].alias("n"))
    own = vocab.select(F.col("word").alias("own"), F.col("n").alias("m"))
    known = best.join(own, "own", "left")
    return known.where(F.col("m").isNull() | (F.col("n") >= 12 * F.col("m"))).where((F.col("own") == "") | (F.col("n") >= 3)).select("token", "right")


def fixes(docs: DataFrame, elements: DataFrame) -> tuple[DataFrame, dict, DataFrame]:
    """The lines with their features, the model, and ``rec, page, line, kind, token, a, b, repaired``: every
    repair beside what stands on the page (a token, or the parts of a broken word)."""
    records = scanned(docs, elements)
    lines = cut(featured(records.repartition(n_partitions(docs))))
    model = train(lines)

    def run(batches):
        for b in batches:
            rows = [(r["rec"], *x) for r in b.to_pylist() if r["syms"] for x in repairs_of(r["lines"], viterbi(r["syms"], model))]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
            types = (pa.string(), pa.int32(), pa.int32(), *[pa.string()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["rec", "page", "line", "kind", "token", "a", "b"])

    found = cut(lines.mapInArrow(run, "rec string, page int, line int, kind string, token string, a string, b string"))
    native = elements.where("extractor <> 'ocr'").select(F.col("text").alias("body")).unionByName(docs.where("extractor <> 'ocr'").select(F.explode_outer(F.coalesce("pages", F.array("text"))).alias("body")))
    scans = lines.select(F.array_join(F.transform("lines", lambda x: x["x"]), "\n").alias("body"))
    vocab = cut(vocabulary(native.unionByName(scans).where("body IS NOT NULL")).where("n > 1"))
    same = lambda kind, right: ("rec", "page", "line", F.lit(kind).alias("kind"), "token", "a", "b", right.alias("repaired"))
    furniture = found.where("kind = 'furniture'").select(*same("furniture", F.lit("")))

    words = found.where("kind = 'word'")
    right = cut(corrections(words.select("token").distinct(), vocab))
    fixed = lookup_join(words, right, "token").select(*same("misread", F.col("right")))

    def ways(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                x, y = core(r["a"]), core(r["b"])
                x = re.sub(rf"[{re.escape(HYPHENS)}]+$", "", x)
                for sep, cost in (("", 0), ("-", 0)):
                    w = x + sep + y
                    plainly = "".join(SIGNS.get(c, c) for c in w) if re.search(r"[a-z]", w) else w
                    out += [(r["a"], r["b"], w, sep, cost)] if w == plainly else [(r["a"], r["b"], plainly, sep, 1)]
                    out += [(r["a"], r["b"], c, sep, 1 + n) for c, n in candidates(w) if c != plainly]
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (*[pa.string()] * 4, pa.int32()), strict=True)], names=["a", "b", "word", "sep", "cost"])

    broken = found.where("kind IN ('tight', 'loose')")
    pairs = broken.select("a", "b").distinct().repartition(n_partitions(docs))
    tried = pairs.mapInArrow(ways, "a string, b string, word string, sep string, cost int").join(vocab, "word", "left")
    # The commonest written form with the fewest changes; of forms the corpus lacks, the plain join.
    known = F.when(F.col("n").isNotNull() & ((F.col("cost") == 0) | (F.col("n") > 2)), 1).otherwise(0)
    order = F.struct(known, F.when(known == 1, -F.col("cost")).otherwise(F.when(F.col("sep") == "", 1 - F.col("cost")).otherwise(-9)), F.coalesce("n", F.lit(0)), "word")
    joined = tried.groupBy("a", "b").agg(F.max_by("word", order).alias("word"), F.max(known).alias("known"))
    both = broken.join(joined, ["a", "b"]).where("kind = 'tight' OR known = 1").select(*same("joined", F.col("word")))
    return lines, model, reduce(DataFrame.unionByName, [furniture, fixed, both])


def repairs(docs: DataFrame, elements: DataFrame) -> DataFrame:
    """``record_id, page, line_no, kind, repaired``: one distinct row for each repair."""
    every = fixes(docs, elements)[2]
    return every.select(F.col("rec").alias("record_id"), "page", F.col("line").alias("line_no"), "kind", "repaired").distinct()


def dressed(token: str, word: str) -> str:
    """``word`` with the outer punctuation and the case of ``token``."""
    at = token.lower().find(core(token))
    old = token[at : at + len(core(token))]
    letters = [c for c in old if c.isalpha()]
    if len(letters) > 1 and all(c.isupper() for c in letters):
        word = word.upper()
    elif old[:1].isupper():
        word = word[:1].upper() + word[1:]
    return token[:at] + word + token[at + len(old) :]


def rebuilt(lines: list[dict], labels: list[str], repaired: list[dict]) -> list[tuple[int | None, str]]:
    """``page, text`` of the paragraphs of one record, its repairs applied."""
    right: dict = {}
    for f in repaired:
        at = (f["page"], f["line"])
        if f["kind"] == "misread":
            right.setdefault(at, {})[f["token"]] = f["repaired"]
        elif f["kind"] == "joined":
            right.setdefault(at, {})[f["a"], f["b"]] = f["repaired"]
    text = [n for n, (r, y) in enumerate(zip(lines, labels, strict=True)) if y == "body" and r["x"].strip()]
    after = {n: lines[m]["x"] for n, m in zip(text, text[1:], strict=False)}
    out: list[tuple[int | None, str]] = []
    words: list[str] = []
    page, was, begun = None, -1, None
    for n, (r, y) in enumerate(zip(lines, labels, strict=True)):
        if y == "body" and r["x"].strip():
            if not words and begun is None:
                page = r["page"]
            here, tokens = right.get((r["page"], r["k"]), {}), r["x"].split()
            first = []
            if begun is not None:  # the rest of a word from the line before
                left, word = begun
                tail = tokens[0][tokens[0].lower().find(core(tokens[0])) + len(core(tokens[0])) :]
                tail, first, tokens, begun = tail, [dressed(left, word)], tokens[1:], None
                first[0] += tail
            broken = broken_at(r["x"], after.get(n))
            if broken and broken[:2] in here:
                begun = (broken[0], here[broken[:2]])
                if tokens:
                    tokens = tokens[: -1 if broken[2] else -2]
                else:
                    begun = None  # the whole line is one middle part
            words += first + [dressed(t, here[t]) if t in here else t for t in tokens]
            was = r["i"]
        elif y == "break" and words and r["i"] == was and begun is None:
            out.append((page, " ".join(words)))
            words = []
    if words:
        out.append((page, " ".join(words)))
    return out


def paragraphs(docs: DataFrame, elements: DataFrame) -> DataFrame:
    """``record_id, page, para, text``: body lines put together again between breaks, with broken words
    joined and misread ones righted as ``repairs`` tells, furniture left out. A paragraph belongs to the
    page where it begins and goes on over page ends; ``para`` counts those of a record from 0."""
    lines, model, every = fixes(docs, elements)
    mine = every.where("kind <> 'furniture'").groupBy("rec").agg(F.collect_list(F.struct("page", "line", "kind", "token", "a", "b", "repaired")).alias("fixes"))

    def run(batches):
        for b in batches:
            out = [(r["rec"], page, n, text) for r in b.to_pylist() if r["syms"] for n, (page, text) in enumerate(rebuilt(r["lines"], viterbi(r["syms"], model), r["fixes"] or []))]
            cols = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.int32(), pa.string()), strict=True)], names=["record_id", "page", "para", "text"])

    return lines.join(mine, "rec", "left").select("rec", "lines", "syms", "fixes").mapInArrow(run, "record_id string, page int, para int, text string")
