"""Parts of names as people type them: of persons and of organisations."""

from __future__ import annotations

import re
import unicodedata

# Given names (for the order of the parts) and short forms of them.
GIVEN = set(
    """alexander alice amanda andrew anna anthony antonio barbara benjamin carlos catherine charles christina
christopher daniel david deborah dmitri dorothy edward elena elizabeth emily eric fatima francisco frank gabriel
gabriela george giuseppe gregory hannah harold helen henry hiroko ingrid ivan jacob james jennifer jessica john
jonathan jose joseph joshua karen katherine kenneth laura lawrence leonard linda louis margaret maria mark martin
mary matthew michael mohammed natalia nathaniel nicholas olga oscar pamela patricia patrick paul peter philip
quentin rachel raymond rebecca richard robert ronald rose samuel sandra sarah sergei sophia stephen susan teresa
theodore thomas timothy ulrich valerie victor victoria vincent walter wanda wei william xavier yusuf zachary""".split()
)
NICKNAMES = dict(
    p.split(":")
    for p in """al:alexander alex:alexander sandy:alexander ally:alice mandy:amanda andy:andrew drew:andrew tony:anthony
barb:barbara ben:benjamin cathy:catherine chuck:charles charlie:charles tina:christina chris:christopher kit:christopher
topher:christopher dan:daniel danny:daniel dave:david deb:deborah debbie:deborah dima:dmitri dot:dorothy ed:edward
eddie:edward ned:edward ted:edward liz:elizabeth beth:elizabeth betty:elizabeth eliza:elizabeth libby:elizabeth
rick:richard em:emily paco:francisco pancho:francisco frankie:frank gabe:gabriel gabby:gabriela gabi:gabriela
beppe:giuseppe pino:giuseppe greg:gregory harry:henry hank:henry hal:harold nell:helen inga:ingrid jake:jacob jim:james
jimmy:james jen:jennifer jenny:jennifer jess:jessica jack:john johnny:john jon:jonathan pepe:jose joe:joseph joey:joseph
josh:joshua kate:katherine kathy:katherine katie:katherine kat:katherine ken:kenneth larry:lawrence len:leonard
lenny:leonard leo:leonard lou:louis maggie:margaret meg:margaret peggy:margaret marge:margaret matt:matthew mike:michael
mick:michael nat:nathaniel nate:nathaniel nick:nicholas nicky:nicholas klaus:nicholas pam:pamela pat:patricia
patty:patricia trish:patricia tricia:patricia paddy:patrick pete:peter phil:philip ray:raymond becky:rebecca
rich:richard dick:richard ricky:richard bob:robert rob:robert bobby:robert robbie:robert bert:robert ron:ronald sam:samuel
sergey:sergei sophie:sophia steve:stephen steven:stephen sue:susan susie:susan suzy:susan terry:teresa theo:theodore
tom:thomas tommy:thomas tim:timothy uli:ulrich val:valerie vic:victor vicky:victoria vicki:victoria tori:victoria
vince:vincent walt:walter bill:william will:william billy:william willy:william liam:william xavi:xavier zach:zachary
zack:zachary zak:zachary que:quentin quin:quentin fati:fatima""".split()
)
TITLES = set("dr mr mrs ms miss mx prof professor capt captain cdr cmdr ltc lt ltcol col colonel gen general maj major sgt adm rear sir rev hon eng ing fr herr frau sr sra".split())
CREDENTIALS = set("phd md pmp pe jr sr ii iii iv esq mba msc bsc ma usn usmc usaf ret cissp cpa dds rn jd".split())

# Legal forms of organisations, one code each.
LEGAL = {
    "limited liability company": "llc", "incorporated": "inc", "corporation": "corp", "company": "co", "limited": "ltd",
    "llc": "llc", "inc": "inc", "corp": "corp", "co": "co", "ltd": "ltd", "group": "group", "grp": "group", "gmbh": "gmbh",
    "plc": "plc", "sa": "sa", "ag": "ag", "bv": "bv", "lp": "lp", "llp": "llp",
}


HAN = "[\u3400-\u9fff]+"


def plain(s: str) -> str:
    """Lower case, no accents, no apostrophes, compatibility forms resolved."""
    s = "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))
    return re.sub(r"\s+", " ", re.sub(r"['’‘`ʼ\"]", "", s)).strip().lower()


def sound(s: str) -> str:
    """One spelling for letters that are heard alike, and for doubled letters."""
    s = re.sub(r"[\W_]", "", s).replace("ph", "f").replace("ck", "k").replace("c", "k").replace("y", "i").replace("z", "s")
    return re.sub(r"(.)\1+", r"\1", s)


def osa(a: str, b: str, most: int = 3) -> int:
    """Edits between two words, a swap of neighbours counting one; ``most`` + 1 if more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    two, one = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(one[j] + 1, row[-1] + 1, one[j - 1] + (x != y))
            if two and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, two[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        two, one = one, row
    return one[-1]


def segment_keys(key: str, limit, most: int) -> tuple[list[str], list[str]]:
    """Keys under which ``key`` waits for longer words, and those under which it looks for shorter ones.

    A word of n letters is cut into ``limit(n)`` + 1 segments; in a longer word within ``limit(n)`` edits
    (``most`` at the highest) one of them stands unchanged, moved by at most its number of edits counted
    from the left and from the right. So two such words share a key, whatever they are."""

    def parts(size: int, r: int):
        each, at = size // (r + 1), 0
        for i in range(r + 1):
            n = each + (i >= r + 1 - size % (r + 1))
            yield i, at, n
            at += n

    n = len(key)
    waits = [f"{n}|{i}|{key[at : at + m]}" for i, at, m in parts(n, limit(n))]
    looks = set()
    for size in range(max(1, n - most), n + 1):
        r, more = limit(size), n - size
        if more <= r:
            for i, at, m in parts(size, r):
                for p in range(max(at - i, at + more - (r - i), 0), min(at + i, at + more + (r - i), n - m) + 1):
                    looks.add(f"{size}|{i}|{key[p : p + m]}")
    return waits, sorted(looks)


_cache: dict[str, str] = {}


def formal(given: str) -> str:
    """The full given name for a short form or a mistyped one; else the word itself."""
    g = NICKNAMES.get(given, given)
    if g in GIVEN or len(g) < 4:
        return g
    if g not in _cache:
        if len(_cache) > 100_000:
            _cache.clear()
        best = sorted((osa(g, x, 2), x) for x in GIVEN if abs(len(x) - len(g)) < 3)
        limit = 1 if len(g) < 6 else 2
        near = [x for d, x in best if d <= limit and d == best[0][0]]
        short = [NICKNAMES[x] for x in NICKNAMES if len(g) >= 4 and len(x) >= 4 and osa(g, x, 1) == 1]
        _cache[g] = near[0] if len(near) == 1 else short[0] if not near and len(set(short)) == 1 else g
    return _cache[g]


def person(name: str) -> tuple[str, str, str, str] | None:
    """``key, given, initial, middle``: sound of the surname, full given name ('' if only an initial)."""
    s = plain(re.sub(r"\([^)]*\)", " ", name))
    parts = []
    for part in s.split(","):
        words = part.replace("-", "").split()
        while words and words[0].rstrip(".") in TITLES and len(words) > 1:
            words = words[1:]
        words = [w for w in words if w.replace(".", "") not in CREDENTIALS or len(w) == 1] if parts else words
        while len(words) > 2 and words[-1].replace(".", "") in CREDENTIALS:
            words = words[:-1]
        if words:
            parts.append(words)
    if not parts:
        return None
    if len(parts) == 1 and len(parts[0]) > 1 and all(re.fullmatch(HAN, w) for w in parts[0]):
        parts = [["".join(parts[0])]]  # family name first, a blank between the parts or not
    short = lambda w: len(w.replace(".", "")) == 1 or (w.endswith(".") and len(w.replace(".", "")) <= 2)
    if len(parts) > 1:
        surname, rest = parts[0], parts[1]
    else:
        words = parts[0]
        if len(words) == 1:  # without a blank only names of Han characters show their parts
            return (words[0][0], words[0][1:], words[0][1], "") if len(words[0]) < 5 and re.fullmatch(HAN, words[0]) else None
        tail = []
        while len(words) > 2 and short(words[-1]):
            tail, words = [words[-1], *tail], words[:-1]
        lead = 0
        while lead < len(words) - 1 and short(words[lead]):
            lead += 1
        if lead:
            rest, surname = words[:lead], words[lead:]
        else:
            known = [2 if w in GIVEN or w in NICKNAMES else formal(w) in GIVEN for w in (words[0], words[-1])]
            if known[1] > known[0]:
                rest, surname = [words[-1], *tail], words[:-1]
            else:
                n = 1
                while n < len(words) - 1 and short(words[n]):
                    n += 1
                rest, surname = [*words[:n], *tail], words[n:]
    key = sound("".join(surname))
    if not key or not rest:
        return None
    first = rest[0].replace(".", "")
    if short(rest[0]):
        letters = "".join(w.replace(".", "") for w in rest)
        return key, "", letters[0], letters[1:2]
    middle = next((w[0] for w in rest[1:]), "")
    g = formal(first)
    return key, g, g[:1], middle


def organization(name: str) -> tuple[str, str, str, str] | None:
    """``key, words, initials, legal``: sound of the leading name, the other words ('' if only their initials)."""
    s = plain(re.sub(r"\([^)]*\)", " ", name)).replace(".", "")
    s = re.sub(r"[&/+_-]| and ", " ", s)
    s = re.sub(r"^the ", "", s.strip())
    legal = ""
    for form, code in LEGAL.items():
        cut = re.sub(rf"[ ,]+{form}$", "", s)
        if cut != s and cut.strip(" ,"):
            s, legal = cut.strip(" ,"), code
            break
    parts = [p.split() for p in s.split(",") if p.split()]
    if not parts:
        return None
    if len(parts) > 1 and len(parts[-1]) == 1 and len(parts[-1][0]) > 4:
        head, rest = parts[-1][0], [w for p in parts[:-1] for w in p]
    else:
        words = [w for p in parts for w in p]
        head, rest = words[0], words[1:]
    key = sound(head)
    if not key:
        return None
    typed = next((w for w in re.sub(r"[&/+_,-]", " ", name).split() if rest and plain(w).replace(".", "") == rest[0]), "")
    if len(rest) == 1 and "." not in typed and (len(rest[0]) <= 2 or (len(rest[0]) == 3 and typed.isupper() and not name.isupper())):
        return key, "", rest[0], legal
    return key, " ".join(rest), "".join(w[0] for w in rest), legal


def same_word(a: str, b: str) -> bool:
    """Equal but for an abbreviation or up to two edits."""
    if a == b:
        return True
    x, y = sorted((a, b), key=len)
    if x[0] == y[0] and len(x) >= 2 and len(x) <= max(5, len(y) - 3):
        at = iter(y)
        if all(c in at for c in x):
            return True
    return len(x) >= 4 and osa(x, y, 2) <= (2 if len(x) > 5 else 1)


def relation(kind: str, a: tuple, b: tuple, edits: int, limit: int = 2) -> int:
    """2: the same by full parts; 1: at least one side has only initials and they agree; 0: not the same."""
    if edits > limit:
        return 0
    _, wa, ia, xa = a
    _, wb, ib, xb = b
    if kind == "PERSON":
        if ia != ib or (xa and xb and xa != xb):
            return 0
        if wa and wb:
            return 2 if wa == wb else 0
        return 1
    if xa and xb and xa != xb:
        return 0
    if not wa and not wb and (ia or ib):
        return 1 if ia == ib else 0
    if wa and wb:
        x, y = wa.split(), wb.split()
        return 2 if len(x) == len(y) and all(same_word(p, q) for p, q in zip(x, y, strict=True)) else 0
    if not ia and not ib:
        return 2
    return 1 if ia == ib else 0
