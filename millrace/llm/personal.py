"""Personal information in free text (problem 9): mailboxes, phone numbers, identity numbers, street addresses, names.

Generators propose overlapping spans by shape alone: mailboxes around each at sign, runs of digits, layouts of identity numbers,
numbers beside words for streets, and for names each run of capitalised words of any cased script, in either order, with initials,
particles and commas; words in lower case and in scripts without case where a label or a courtesy stands beside them. No list of names
takes part. Boosted trees score each span from its format and from its context: the ``LEFT`` characters before and ``RIGHT`` after
it, how common its words are (:mod:`millrace.llm.lexicon`), and whether the text has them in lower case too. A span is kept if
its score reaches the threshold of its kind; of overlapping ones the best stays.

Trees and thresholds are fitted on the driver, once per process, to :func:`millrace.llm.sentences.labelled` (``ROWS`` made-up sentences, a
documented bound; no row or sentence of the corpus is used), the thresholds on a held-out third. The model has a fixed size and is
broadcast.

Null, empty and blank texts hold nothing. Positions count code points from 0. Each piece counts at its own place, also in
repeated texts.
"""

from __future__ import annotations

import functools
import pickle
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm import lexicon
from millrace.llm.boosting import BoostedTrees
from millrace.llm.sentences import KINDS, labelled

#: Labelled sentences that the model is fitted to.
ROWS = 16_000
#: Characters of context before and after a span that features look at.
LEFT, RIGHT = 48, 28
#: Doublings of rank from which a word may be part of a name in lower case: words beyond some 4,000 commonest of a vocabulary.
RARE = 13


class Candidate(NamedTuple):
    kind: int
    form: int
    start: int
    end: int
    words: tuple[str, ...] = ()  # of a name: its given part, its family part
    run: int = 0  # of a name: capitalised words in a row around it


# --- generators ---------------------------------------------------------------------------------------------------------
# Patterns begin with a plain set of characters, which the engine looks for quickly; what must not stand before follows as a look-behind.

_DOT = r"(?:\s?[\[({<]\s?(?:dot|DOT|punkt|punto|point|\.)\s?[\])}>]\s?| DOT | dot |\.)"
_DOMAIN = re.compile(rf"[A-Za-z0-9](?:[\w-]*{_DOT})+[A-Za-z]\w+")
_SPELLED = re.compile(r"[\[({< ]\s?(?:at|AT|At|@|arroba)\s?[\])}> ]\s?(?=[A-Za-z0-9][\w-]*(?:\s?[\[({<]\s?(?:dot|DOT|punkt|punto|point|\.)| DOT | dot |\.))")
_SIGN = re.compile(r"[@＠&%](?:(?<=[@＠])|(?<=&)#64;|(?<=%)40)")
_LOCAL = frozenset(".+%-_")
_PHONE = re.compile(r"[+(\d](?<![\w.+#-].)[\d ().\-/]{5,22}\d(?![\w-])")
_DIGITS = re.compile(r"[A-Z\d](?<![\w.+/-].)[\dA-Z]{1,3}[\dA-Z .+/-]{4,22}")
# Layouts of identity numbers.
_LAYOUTS = [
    re.compile(rf"(?:{p})(?![\w-]|[./]\w)")
    for p in (
        r"\d{3}[- ]\d{2}[- ]\d{4}", r"\d{9}", r"\d{3}\.\d{3}\.\d{3}-\d{2}", r"\d{8}[- ]?[A-Z]", r"[XYZ][- ]?\d{7}[- ]?[A-Z]", r"[A-Z]{1,2} ?\d{6,9}", r"\d{2} \d{3} \d{3} \d{3}|\d{11}", r"\d{6}[-+]\d{4}",
        r"[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-D]", r"\d{3} \d{3} \d{3}", r"\d{4} \d{4} \d{4}", r"[A-Z]{5}\d{4}[A-Z]", r"[12] ?\d{2} ?\d{2} ?\d{2} ?\d{3} ?\d{3}(?: ?\d{2})?", r"[A-Z]{6}\d{2}[A-Z]\d{2}[A-Z]\d{3}[A-Z]", r"\d{2}\.\d{2}\.\d{2}-\d{3}\.\d{2}",
    )
]
_UP = "".join(chr(c) for c in range(0x41, 0x590) if chr(c).isupper())
_W = rf"[{_UP}][\w'’.-]*"
_CITY = rf"[^\W\d_][\w'’-]+(?: [{_UP}][\w'’-]*)?"
_BEFORE = r"(?<![\w/.-].)"
# Words for streets in several languages.
_STREETS = [
    re.compile(rf"\d{_BEFORE}\d{{0,4}}[A-Za-z]?,? (?:{_W} ){{1,3}}(?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Close|Court|Ct|Drive|Dr|Way|Place|Pl|Square|Sq|Crescent|Terrace|Boulevard|Blvd|Highway|Hwy|Parkway|Row|Walk|Grove|Gardens|Quay|Hill)\b\.?(?:,? (?:Apt|Suite|Unit|Floor|Flat|Room|Ste|#)\.? ?\w+)?(?:, {_CITY})?(?:,? [A-Z]{{1,2}}[\dA-Z]* ?\d\w*)?"),
    re.compile(rf"\d{_BEFORE}\d{{0,3}}(?: ?(?:bis|ter))?,? (?:rue|avenue|boulevard|place|chemin|allée|impasse|quai|route|cours|Rue|Avenue|Boulevard|Place|Chemin|Allée|Impasse|Quai|Route)(?: (?:de la|de l['’]|de|du|des|d['’]))? ?{_W}(?: {_W}){{0,2}}(?:, \d{{4,5}} {_CITY})?"),
    re.compile(rf"[CAPRTLVu](?<!\w.)(?:alle|venida|vda\.|laza|aseo|amino|ua|ravessa|argo|raça|ia|iale|iazza|orso|icolo|/|l\.)(?: (?:de la|de los|de las|de|da|do|dos|das|del|della|dei|di))? {_W}(?: {_W}){{0,2}},? (?:n\.? ?º? ?)?\d{{1,4}}(?:, \d{{1,2}}º ?\w?)?(?:, \d{{2}}-?\d{{3}}(?:-\d{{3}})? {_CITY})?"),
    re.compile(rf"[{_UP}](?<![\w-].)[\w-]*(?:straße|strasse|str\.|weg|gasse|allee|platz|damm|ufer|ring|laan|straat|gracht|gatan|vägen|vej|gade|veien|katu) \d{{1,4}} ?[a-z]?\b(?:, (?:[A-Z]{{1,2}}-)?\d{{4,5}} {_CITY})?"),
]
_FLAT = re.compile(r"(?:Flat|Apt\.?|Apartment|Unit|Suite|Room|Ste\.?) \w+, $")
#: One of these stands in any text with an address of that form.
_STREET_WORDS = (
    [f" {w}" for w in ("Street", "St", "Ave", "Road", "Rd", "Lane", "Ln", "Close", "Court", "Ct", "Dr", "Way", "Pl", "Sq", "Crescent", "Terrace", "B", "Highway", "Hwy", "Parkway", "Row", "Walk", "Grove", "Gardens", "Quay", "Hill")],
    ["rue", "avenue", "boulevard", "place", "chemin", "allée", "impasse", "quai", "route", "cours", "Rue", "Avenue", "Boulevard", "Place", "Chemin", "Allée", "Impasse", "Quai", "Route"],
    ["Calle ", "Avenida ", "Avda. ", "Plaza ", "Paseo ", "Camino ", "Rua ", "Travessa ", "Largo ", "Praça ", "Via ", "Viale ", "Piazza ", "Corso ", "Vicolo ", "C/ ", "ul. ", "al. "],
    [f"{w} " for w in "straße strasse str. weg gasse allee platz damm ufer ring laan straat gracht gatan vägen vej gade veien katu".split()],
)
# Particles inside family names.
_PARTICLE = r"(?:von|van|de|der|den|del|della|di|da|do|dos|du|la|le|el|al|bin|ibn|ter|zu|y|e)"
_CAP = rf"[{_UP}](?:[^\W\d_]|['’](?=[^\W\d_]))+(?:-[^\W\d_]+)*"
_UNIT = rf"(?:{_CAP}|[{_UP}]\.(?!\w))"
_RUN = re.compile(rf"[{_UP}](?<![\w@.\-/#$'’\\].)(?:(?:[^\W\d_]|['’](?=[^\W\d_]))+(?:-[^\W\d_]+)*|\.(?!\w))(?:,? (?:{_PARTICLE} ){{0,2}}{_UNIT})+(?![\w@/(]|[._]\w)")
_TOKEN = re.compile(rf"(?P<w>[^\s,]+)(?P<c>,)?")
# Words before a person in lower case.
_CUE = "(?:" + "|".join(f"{w}|{w.capitalize()}" for w in "by from to with cc for and as ms mr mrs dr prof an von por par à frau herr dear hi hello owner author".split()) + r")\.?"
_PLAIN = rf"(?P<g>[^\W\d_A-Z]{{2,}}|[a-z]\.) (?P<f>(?:{_PARTICLE} )?[^\W\d_A-Z]{{2,}}(?:-[^\W\d_]+)*)(?![\w@/(\-]|[._]\w)"
_LOW = [re.compile(rf"[ \n(>#*]{_CUE} {_PLAIN}"), re.compile(rf"[:：=;|>(\"'\[，、。] ?{_PLAIN}")]
_HAN = re.compile(r"[\u4e00-\u9fff]{2,4}(?:[:：]\s?|は)(?P<n>[\u4e00-\u9fff\u3040-\u30ff]{2,6}|[\uac00-\ud7a3]{2,4})(?=[\s、，。,;；)）（(<]|さん|様|氏|先生|女士|$)|[\uac00-\ud7a3]{2,4}[:：]\s?(?P<k>[\uac00-\ud7a3]{2,4})(?![\uac00-\ud7a3])")


def _mailboxes(text: str) -> Iterator[Candidate]:
    marks = [(m, 0) for m in _SIGN.finditer(text)] if "@" in text or "＠" in text or "&#64;" in text or "%40" in text else []
    marks += [(m, 1) for m in _SPELLED.finditer(text)]
    for m, form in marks:
        b = m.start()
        while form and b and text[b - 1] == " ":
            b -= 1
        a = b
        while a and (text[a - 1].isalnum() or text[a - 1] in _LOCAL):
            a -= 1
        while a < b and not text[a].isalnum():
            a += 1
        d = _DOMAIN.match(text, m.end())
        if d and a < b and text[a - 1 : a] not in ("@", "/", "&"):
            if form and m[0].strip() in ("at", "At", "AT") and not re.search(r"(?i)\bdot\b|[\[({<]", d[0]):
                continue  # plain words around a plain dot
            yield Candidate(0, form, a, d.end())


def _phones(text: str) -> Iterator[Candidate]:
    for m in _PHONE.finditer(text):
        a, b = m.span()
        t = m[0]
        if t[0] == "(" and (")" not in t or t[1:2] in "(+" or t.find(")") > 7):
            a += 1
            while a < b and text[a] == " ":
                a += 1
            t = text[a:b]
        if t.count(")") > t.count("("):
            b = a + t.index(")")
            t = text[a:b]
        if 8 <= sum(map(str.isdigit, t)) <= 16:
            yield Candidate(1, 0, a, b)


def _numbers(text: str) -> Iterator[Candidate]:
    for m in _DIGITS.finditer(text):
        if sum(map(str.isdigit, m[0])) < 4:
            continue
        for at in [m.start(), *(m.start() + i + 1 for i, c in enumerate(m[0][:-1]) if c in " /")]:
            if at and (text[at - 1].isalnum() or text[at - 1] in "._+-"):
                continue
            for k, p in enumerate(_LAYOUTS):
                x = p.match(text, at)
                if x:
                    yield Candidate(2, k, at, x.end())


def _addresses(text: str) -> Iterator[Candidate]:
    for k, pattern in enumerate(_STREETS):
        if not any(w in text for w in _STREET_WORDS[k]):
            continue
        for m in pattern.finditer(text):
            a = m.start()
            flat = _FLAT.search(text, max(0, a - 24), a)
            yield Candidate(3, k, flat.start() if flat else a, m.end())


def _names(text: str) -> Iterator[Candidate]:
    for m in _RUN.finditer(text):
        toks = [(m.start() + t.start("w"), m.start() + t.end("w"), t["w"], bool(t["c"])) for t in _TOKEN.finditer(m[0])]
        caps = [i for i, t in enumerate(toks) if t[2][0].isupper()]
        full = [len(t[2]) > 2 or len(t[2]) == 2 and t[2][1] != "." for t in toks]
        for i in caps:
            start, _, given, comma = toks[i]
            j = i + 1
            if j == len(toks):
                break
            if comma:  # family, given
                if full[i] and toks[j][2][0].isupper():
                    yield Candidate(4, 1, start, toks[j][1], (toks[j][2], given), len(caps))
                continue
            k = j
            while k < len(toks) and not toks[k][3] and (not full[k] or toks[k][2][0].islower()) and k - j < 3:  # initials and particles
                k += 1
            if k < len(toks) and full[k] and toks[k][2][0].isupper():
                yield Candidate(4, 0 if k == j else 2, start, toks[k][1], (given, toks[k][2]), len(caps))
                if k == j and full[i] and not toks[j][3] and j + 1 < len(toks) and full[j + 1] and toks[j + 1][2][0].isupper():
                    yield Candidate(4, 3, start, toks[j + 1][1], (given, toks[j + 1][2]), len(caps))


def _plain_names(text: str, words: lexicon.Lexicon) -> Iterator[Candidate]:
    """Names in lower case after what points to a person, whose words are no common ones; names in scripts without case after a label."""
    for p in _LOW:
        for m in p.finditer(text):
            last = m["f"].rsplit(" ", 1)[-1]
            if m["g"].islower() and last.islower() and min(words.rank(m["g"])[0], words.rank(last)[0]) >= RARE:
                yield Candidate(4, 4, m.start("g"), m.end(), (m["g"], last))
    if not text.isascii():
        for m in _HAN.finditer(text):
            g = "n" if m["n"] else "k"
            yield Candidate(4, 5, *m.span(g), (m[g], m[g]))


def candidates(text: str, words: lexicon.Lexicon) -> list[Candidate]:
    """All proposals, overlapping ones included."""
    return [*_mailboxes(text), *_phones(text), *_numbers(text), *_addresses(text), *_names(text), *_plain_names(text, words)]


# --- features -----------------------------------------------------------------------------------------------------------
# Words that speak for or against a kind, in several languages.

_CUES = [
    re.compile(r"(?i)(?:phone|\btel|fax|call|mobile|\bcell|handy|dial|ring|sms|text|whatsapp|hotline|reach|telefon|tel[eé]f|t[eé]l|m[oó]vil|erreich|电话|電話|전화|手机)"),
    re.compile(r"(?i)(?:\bssn|social|passport|national|identi|\bid\b|id[ _-]?(?:no|num|card)|\btax|\btin\b|insurance|\bnino\b|\bdni|\bnie|\bnif|\bcpf|steuer|personnummer|pesel|aadhaar|\bpan\b|\bbsn|s[eé]cu|fiscal|reisepass|ausweis|pasaporte|passeport|licen[cs]e)"),
    re.compile(r"(?i)(?:address|street|live[sd]?\b|resid|office|ship|deliver|post|mail(?:ed)?\b|adresse|addr|anschrift|domicil|direcci|indirizzo|wohn|locat|visit|home|住所|地址)"),
    re.compile(r"(?i)(?:mail|reply|\bto\b|\bb?cc\b|write|contact|question|ask|send|via|from|邮箱|メール)\W*$"),
    re.compile(r"(?i)(?:order|is[bs]n|doi|build|version|timestamp|epoch|commit|sha|digest|hash|port|ticket|invoice|serial|sku|part|issue|release|rows|checksum|batch|job|request|trace|model|article|item|page|section|line|ref(?:erence)?|took|ratio|size|offset|such as|count|v)\W{0,3}(?:no\.?|number|id|#)?\W{0,3}$"),
    re.compile(r"(?i)(?:git|ssh|scp|clone|rsync|npm|npx|pip|yarn|install|add|pin|package|docker|image|svn|import|remote|sftp)\W*[\w-]*\W*$"),
    re.compile(r"(?i)(?:owner|author|contact|maintain|report|sign|review|assign|thank|name|wrote|writ|call|person|staff|employ|custom|client|applic|holder|user)\w*\W*$"),
    re.compile(r"(?:^|[\"'=:：;|(>\[\n,、，。])\s*$"),
    re.compile(r"\d\s?[-–./]?\s?$|(?i:between|range|from)\s$"),
]
_AFTER = [
    re.compile(r"(?i)^\s?(?:rows|bytes|[kmg]i?b\b|m?s\b|secs?\b|seconds|minutes|hours|items|files|times|lines|px|records|points|requests|tokens|entries|%)"),
    re.compile(r"^(?::[\w/~]|/\w|\{|\(\)|=\w)"),
    re.compile(r"^\s*[<(;|,/-]?\s*[\s\w.+-]*[@+\d]"),
    re.compile(r"^(?:\s*$|[\s,.;:!?\"'|)\]<}。、，])"),
    re.compile(r"^[.:,]\d|^ ?[:x×*=]\s?\d"),
]
_RESERVED = re.compile(r"(?i)(?:example|test|invalid|local|com|org|net|de|fr|es|it|io|edu|gov|co\W?uk|uk|jp|cn|eu|info)$")
_ORDER = re.compile(r"\d+")


def _spans(text: str, c: Candidate) -> list[float]:
    """Features of mailboxes, numbers and addresses."""
    kind, form, a, b = c[:4]
    t, left, right = text[a:b], text[max(0, a - LEFT) : a], text[b : b + RIGHT]
    groups = _ORDER.findall(t)
    sizes = list(map(len, groups)) or [0]
    row = [float(kind == k) for k in range(4)] + [float(form), len(t), sum(sizes), t.count(" "), t.count("-"), t.count("."), t.count("/"), float(t[:1] == "+"), float(t[:1] == "("), float(t[:1] == "0"), float(t[:2] == "00"), len(groups), sizes[0], sizes[-1], max(sizes)]
    row += [float(bool(x.search(left))) for x in _CUES] + [float(bool(x.search(right))) for x in _AFTER]
    before = left[-1:]
    row += [float(before.isspace() or not before), float(before in "-/@.#_$" and bool(before)), float("\n" in left[-3:] or not left)]
    if kind == 0:
        local, _, domain = re.split(r"(@|＠|&#64;|%40|\s?[\[({<]\s?(?:at|AT|At|@|arroba)\s?[\])}>]\s?| AT | at | At )", t, maxsplit=1)
        row += [float(bool(_RESERVED.search(domain))), len(local), float(bool(re.search(r"\d+\.\d+", domain))), float(local.lower() in ("git", "root", "ubuntu", "admin")), float(right[:1] == ":" and right[1:2].isalnum()), float("/" in right[:2])]
    elif kind == 3:
        row += [float(bool(re.search(r"\d{4,}", t))), float(t.count(",")), float(t[:1].isdigit()), float(bool(re.search(r"[A-Z]{1,2}\d\w* ?\d", t))), 0.0, 0.0]
    else:
        low = left.lower()
        row += [float(t.isdigit()), float(any(x.isalpha() for x in t)), float(left.rstrip().endswith((":", "=", "："))), float(low.rstrip().endswith(("-", "/"))), float(left[-1:] == "("), float(right[:1] == ")")]
    return row


# Classes of words right before a name, in several languages.
_WHO = [
    frozenset(x.split())
    for x in (
        "owner owners author authors contact contacts contacto kontakt maintainer maintainers reviewer reviewers approver assignee responsible responsable manager lead editor translator customer client applicant employee patient driver tenant student teacher recipient sender holder person engineer founder director witness guest member",
        "mr mrs ms mx dr prof sir herr herrn frau sr sra srta don doña mme mlle m signora signor",
        "by von por par durch",
        "from to with for of cc via per an pour de di à a",
        "and or as y et und e both",
        "thank thanks dear hello hi hey regards cheers sincerely best bye ask tell meet ping email mail welcome congratulations credit credits call",
        "the a an our your their its this that these each every any all no new der die das den dem ein eine le la les un une el los las una o os as il lo",
        "name names called named am i'm nombre nom nome",
        "is was are were be been has",
        "according assigned belongs given handed sent owed granted due addressed introduced",
    )
]
_BACK = re.compile(r"([^\w]{0,6})([^\W\d_]*)([^\w]{0,4})([^\W\d_]*)")
_FORWARD = re.compile(r"([^\w]{0,4})([^\W\d_]*)")
_MARKS = "\"'=;|(>[,:：-_.!?\n*#/、，。<)"
_REACH = re.compile(r"\W{1,4}(?:[\w.+-]+ ?(?:@|＠|\W?(?:at|AT)\W)|\+?\(?\d)")
_LABEL = re.compile(r"(?i),? \w+ (?:no\b|number|id\b|id:)|,? (?:[A-Z]{3,4}\b|passport|tax|national|social)")


def _left(text: str, a: int, words: lexicon.Lexicon) -> list[float]:
    """Features of what stands before a name: the last two words by class and rank, and the marks after them."""
    gap, w1, gap2, w2 = _BACK.match(text[max(0, a - LEFT) : a][::-1]).groups()
    w1, w2 = w1[::-1], w2[::-1]
    low1, low2 = w1.lower(), w2.lower()
    row = [float(low1 in c) for c in _WHO] + [float(low2 in c) for c in _WHO]
    row += [float(m in gap) for m in _MARKS] + [float(gap.count(" ")), float(not w1), float("-" in gap2), float("_" in gap2 or text[a - 1 : a] == "_")]
    row += [words.rank(w1)[0] if w1 else -1.0, float(w1[:1].isupper()), float(w1.isupper()), float(low1.endswith(("ed", "en", "te", "or", "er"))), float(low2.endswith(("ed", "en", "te"))), float(low1.endswith("s"))]
    return row


def _right(text: str, b: int, words: lexicon.Lexicon) -> list[float]:
    """Features of what stands after a name."""
    right = text[b : b + RIGHT]
    gap, w = _FORWARD.match(right).groups()
    row = [float(m in gap) for m in _MARKS] + [float(gap == " "), float(gap == ". "), float(not right), float(gap in ("'", "’") and w == "s")]
    row += [words.rank(w)[0] if w else -1.0, float(w[:1].isupper()), float(w.endswith(("ed", "te", "ó", "ou", "it"))), float(w.endswith("en")), float(w in ("said", "says", "asked", "wrote", "will", "has", "had", "was", "is", "can", "put", "told")), float(bool(_ORG.match(w))), float(w.lower() in _WHO[4])]
    return row + [float(bool(_REACH.match(right))), float(bool(_LABEL.match(right)))]


# Words that end names of organisations and of places.
_ORG = re.compile(r"(?i)^(?:systems?|inc|ltd|llc|gmbh|corp|co|labs?|group|teams?|foundation|project|university|college|institute|bank|street|road|avenue|lane|way|square|park|river|lake|bay|hill|island|city|county|state|conference|edition|guide|manual|handbook|standard|protocol|license|award|weg|platz|stra(?:ß|ss)e|gasse|engine|software|technologies|solutions|partners|media|press|studio|services?)$")


def _name(text: str, c: Candidate, words: lexicon.Lexicon, low: str, seen: dict[int, list[float]]) -> list[float]:
    """Features of names. ``low`` is the text in lower case; ``seen`` keeps what was computed for a place of the text."""
    _, form, a, b = c[:4]
    given, fam = c.words
    t = text[a:b]
    g1, g2 = words.rank(given.rstrip("."))
    f1, f2 = words.rank(fam)
    row = [float(form == k) for k in range(6)] + [len(t), t.count(" "), float(c.run), g1, g2, f1, f2, max(g1, f1), min(g1, f1), g1 - g2, f1 - f2, words.stem(given), words.stem(fam), len(given), len(fam), float(given.endswith(("e", "en"))), float(fam.endswith("s")), float(len(given) == 2 and given[1] == "."), float(t.isupper()), float("-" in t), float("'" in t or "’" in t), float(t.isascii())]
    row += [float(f" {w.lower()} " in low) for w in (given, fam)] + [float(bool(_ORG.match(given))), float(bool(_ORG.match(fam))), float(any(x[0].islower() for x in t.split()[1:-1]))]
    if a not in seen:
        seen[a] = _left(text, a, words)
    if -b not in seen:
        seen[-b] = _right(text, b, words)
    return row + seen[a] + seen[-b]


def features(text: str, cands: list[Candidate], words: lexicon.Lexicon) -> list[list[float]]:
    """A row per candidate of one text; rows of names and of other kinds differ in width."""
    low, seen = text.lower(), {}
    return [_name(text, c, words, low, seen) if c.kind == 4 else _spans(text, c) for c in cands]


# --- model --------------------------------------------------------------------------------------------------------------


class Model(NamedTuple):
    spans: BoostedTrees
    names: BoostedTrees
    cut: list[float]
    words: lexicon.Lexicon

    def scores(self, cands: list[Candidate], rows: list[list[float]]) -> np.ndarray:
        p = np.zeros(len(cands))
        for trees, name in ((self.spans, False), (self.names, True)):
            at = [i for i, c in enumerate(cands) if (c.kind == 4) == name]
            if at:
                p[at] = trees.predict(np.array([rows[i] for i in at], np.float32))
        return p


@functools.lru_cache(maxsize=1)
def model(rows: int = ROWS, seed: int = 5) -> Model:
    """Trees for spans and for names, fitted to two thirds of the sentences, and a threshold per kind that has the best F1 on the rest."""
    words = lexicon.read()
    y, part, kind, x_of = [], [], [], []
    for i, (text, spans) in enumerate(labelled(rows, seed)):
        own = candidates(text, words)
        x_of += features(text, own, words)
        y += [any(c.kind == k and c.start == a and (k != 4 or c.end == b) for k, a, b in spans) for c in own]
        part += [i // 10 % 3] * len(own)
        kind += [c.kind for c in own]
    y, part, kind = np.array(y), np.array(part), np.array(kind)
    cut, trees = [0.5] * 5, []
    for name in (False, True):
        own = (kind == 4) == name
        x = np.array([v for v, k in zip(x_of, own) if k], np.float32)
        yy, pp, kk = y[own], part[own], kind[own]
        fitted = BoostedTrees(rounds=60 if name else 40, depth=5 if name else 4, rate=0.3).fit(x[pp > 0], yy[pp > 0])
        trees.append(fitted)
        p = fitted.predict(x[pp == 0])
        for k in (4,) if name else range(4):
            q, t = p[kk[pp == 0] == k], yy[pp == 0][kk[pp == 0] == k]
            tries = np.linspace(0.2, 0.8, 25)
            f1 = np.array([2 * (t & (q >= v)).sum() / max(1, t.sum() + (q >= v).sum()) for v in tries])
            good = tries[f1 >= f1.max() - 1e-9]
            cut[k] = float(good[np.abs(good - 0.5).argmin()])
    return Model(*trees, cut, words)


def pieces(texts: list[str | None], m: Model) -> list[list[tuple[int, int, int]]]:
    """``(kind, start, end)`` of each text's pieces, by start, without overlaps."""
    of, cands, rows = [], [], []
    for i, t in enumerate(texts):
        if t:
            own = candidates(t, m.words)
            if own:
                cands += own
                of += [i] * len(own)
                rows += features(t, own, m.words)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    p = m.scores(cands, rows)
    for k in sorted(range(len(p)), key=lambda k: (of[k], -round(float(p[k]), 3), cands[k].start - cands[k].end, cands[k].start)):
        i, (kind, _, a, b, *_) = of[k], cands[k]
        if p[k] >= m.cut[kind] and all(b <= x or a >= y for _, x, y in out[i]):
            out[i].append((kind, a, b))
    return [sorted(v, key=lambda v: v[1]) for v in out]


def redact(text: str | None, found: list[tuple[int, int, int]]) -> str | None:
    if not text or not found:
        return text
    out, at = [], 0
    for kind, a, b in found:
        out += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = b
    return "".join([*out, text[at:]])


#: Texts scored at a time.
BATCH = 500


def _run(df: DataFrame, key: str, schema: str, emit) -> DataFrame:
    held = df.sparkSession.sparkContext.broadcast(pickle.dumps(model()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pickle.loads(held.value)
        for whole in batches:
            for i in range(0, whole.num_rows, BATCH):
                b = whole.slice(i, BATCH)
                texts = b.column(1).to_pylist()
                yield emit(b, texts, pieces(texts, m))

    return df.select(key, "text").mapInArrow(run, schema)


def personal_pieces(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, pii_kind, start_pos, end_pos)`` of each piece in ``text``."""

    def emit(b: pa.RecordBatch, texts: list, found: list) -> pa.RecordBatch:
        flat = [(i, *f) for i, v in enumerate(found) for f in v]
        col = lambda k, t: pa.array([x[k] for x in flat], t)
        return pa.RecordBatch.from_arrays([b.column(0).take(col(0, pa.int32())), pa.array([KINDS[x[1]] for x in flat], pa.string()), col(2, pa.int64()), col(3, pa.int64())], [key, "pii_kind", "start_pos", "end_pos"])

    return _run(df, key, f"`{key}` {df.schema[key].dataType.simpleString()}, pii_kind string, start_pos bigint, end_pos bigint", emit)


def redacted_texts(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, redacted, n)``: texts with typed placeholders and the number of pieces; null stays null."""

    def emit(b: pa.RecordBatch, texts: list, found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([b.column(0), pa.array([redact(t, f) for t, f in zip(texts, found)], pa.string()), pa.array(list(map(len, found)), pa.int32())], [key, "redacted", "n"])

    return _run(df, key, f"`{key}` {df.schema[key].dataType.simpleString()}, redacted string, n int", emit)
