"""Credentials in source and configuration files (problem 6).

Every quoted string and every other run of characters without spaces is a candidate: a content is cut into these once. What
stands before a candidate in its line, up to ``BEFORE`` of them, tells how strongly it is expected to be a credential (``Evidence``):
nothing, a phrase or name that speaks of one, a place that can hold nothing else (the password of an address, a header, a flag), or an issuer's
format. The Shannon entropy of the value decides: it must reach :func:`threshold`, a share of what a random string of that length
over that alphabet has, and the share falls with the evidence. Values of letters alone are judged by how little they look like
words instead (bits per letter under letter pairs of a public lexicon). Placeholders, references to variables or vaults, digests, revisions,
build ids, public keys, names of other things and rows of encoded blobs are left out.

Null, empty and blank contents hold nothing. Lines are counted at newlines, from 1. A value that is split over
several literals counts once, where its first part starts; a private key counts at its header line.
"""

from __future__ import annotations

import base64
import binascii
import functools
import math
import re
from collections import Counter
from collections.abc import Iterator
from enum import IntEnum

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import lexicon


class Evidence(IntEnum):
    """How strongly the surroundings of a string speak for a credential."""

    NONE = 0
    NAME = 1
    PLACE = 2
    ISSUER = 3


#: Share of the greatest entropy, log2 of the lesser of length and alphabet, that a value needs by evidence.
SHARE = {Evidence.NONE: 0.78, Evidence.NAME: 0.62, Evidence.PLACE: 0.55, Evidence.ISSUER: 0.5}
#: Bits per letter from which letters don't look like words; for values without digits.
WORDLESS = 5.25
#: Candidates before a value in its line that are read for evidence.
BEFORE = 16
#: Shortest value that may be a credential, and shortest one without evidence.
LEAST, UNNAMED = 6, 20
#: Characters from which a base64 text without evidence is a blob.
BLOB = 128

# Last words of names that speak of a credential.
NAME = r"(?:passwords?|passwd|passphrase|passcode|pass|pwd|pw|secret|secrets|token|api[_-]?key|access[_-]?key|private[_-]?key|signing[_-]?key|secret[_-]?key|encryption[_-]?key|master[_-]?key|account[_-]?key|auth[_-]?key|service[_-]?key|ssh[_-]?key|bearer|auth|authorization|credentials?|credential|cred)"
# Tokens that their issuers' formats give away.
ISSUED = re.compile(
    r"(?<![\w+/=-])(?:"
    r"(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{30,}|github_pat_\w{30,}|glpat-[\w-]{18,}|xox[abeprs]-[\w-]{16,}|hf_[A-Za-z0-9]{24,}|AIza[\w-]{30,}"
    r"|sk-(?:[a-z]+-)?[A-Za-z0-9_-]{20,}|[sr]k_(?:live|test)_[A-Za-z0-9]{16,}|npm_[A-Za-z0-9]{30,}|pypi-[\w-]{30,}|dop_v1_[0-9a-f]{40,}|SG\.[\w-]{16,}\.[\w-]{16,}|eyJ[\w-]{16,}\.[\w-]{16,}\.[\w-]{16,}"
    r")(?![\w+/=])"
)
PEM = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----")
_REST = r"(?:(?:[_.$-]|\d|(?-i:(?<=[a-z])[A-Z]))[\w.$-]*+)?"
_NAMED = rf"(?P<name>(?<![A-Za-z0-9])(?:[\w.$-]*[._$-]|[\w.$-]*?(?-i:(?<=[a-z0-9])(?=[A-Z]))|[\w.$-]*?){NAME}(?P<rest>{_REST}))"
_OP = r"(?:\|\|=|\?\?=|:=|=>|:\s*=|=|:(?!//))"
#: A name and an assignment right before a value.
ASSIGNED = re.compile(rf"(?i){_NAMED}(?P<close>[\"'`\]]*)\s*(?P<op>{_OP}|,)\s*(?:new\s+\w+\()?\(?\s*$")
#: A header or flag, the scheme of one, a row of a table, a phrase.
HEADER = re.compile(r"(?i)\b(?:x-[\w-]*(?:key|token|auth|secret)|(?:proxy-)?auth(?:orization)?)[\"'`\]]*\s*(?:[:=,]|=>)\s*[\"'`]?$")
SCHEME = re.compile(r"(?i)(?<![\w-])(?P<scheme>basic|bearer|token)\s+$")
USER = re.compile(r"(?<!\S)(?:-u|--user|--proxy-user)(?:\s+|=)$")
FLAG = re.compile(r"(?i)(?<!\S)--?(?:token|key|password|passwd|pass|secret|api-?key|auth-?token|access-?token|client-?secret)(?:\s+|=)$|\bsshpass\s+-p\s*$|\bmysql\b.*\s-p$")
TABLE = re.compile(rf"(?i)\|\s*{_NAMED}\s*\|\s*$")
PROSE = re.compile(rf"(?i)(?:(?<![A-Za-z0-9]){NAME}|\b\w+_key)\b(?:\s+(?:is|for|of|was)\b[^:`|\n]*)?\s*(?:[:|]|\bis\b)?\s*$")
PROSE_BARE = re.compile(rf"(?i)(?:/ |\b|_){NAME}(?: (?:for|until|since|from|of|on|in|to) [\w -]+)?(?::| is| was| /| =|) $")
# Words after NAME in a name that make it the name of something else than the credential.
OTHER = re.compile(r"(?i)(?:^|[_.$-]|(?-i:(?<=[a-z])(?=[A-Z])))(?:ids?|names?|urls?|uri|paths?|files?|filename|dir|folder|counts?|len|length|min|max|size|limit|budget|types?|kind|method|mode|hash|hashed|digest|checksum|sha\d*|env|var|variable|expir\w*|ttl|age|date|time|timeout|at|refs?|reference|arn|provider|version|policy|field|column|header|prefix|suffix|label|class|endpoint|host|port|scopes?|format|pattern|regex|status|error|message|hint|prompt|help|desc|description|user|username|email|public|pub|fingerprint)(?=$|[_.$-]|\d|(?-i:[A-Z]))")

_PLACE = re.compile(
    r"(?i)^(?:x{3,}|\*{3,}|\.{3,}|-+|_+|#+|0+|(?:your|my|the|some|insert|enter|put|add|set|replace)[ _-].*|.*(?:placeholder|change[ _-]?me|replace[ _-]?me|redacted|dummy|example[ _-]|[ _-]here$|not[ _-]set|to[ _-]?do\b|fixme).*|todo|none|null|nil|true|false|undefined|secret|password|token|vault|env|string|str|required|optional|test|example|sample|default|empty|unset|changeit)$"
)
_REFER = re.compile(r"\$\{|\$\(|\{\{|\}\}|<[\w -]+>|^\$\w|^%\w+%$|^@|process\.env|os\.environ|getenv|ENV\[|secrets?\.|vault[:./]|^(?:env|ref|ssm|kms|arn|file|op|keyring|vault)[:/]|^\w+\(|^\{[\w.]+\}$")
_HEX, _UUID = re.compile(r"(?i)^[0-9a-f]{16,}$"), re.compile(r"(?i)^[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
_PUBLIC = re.compile(r"^(?:ssh-|ecdsa-|sha\d+[:-]|md5[:-]|-----BEGIN (?:PUBLIC|CERT))")
#: Values of names with a rest that are none: dates, times, versions.
_WHEN = re.compile(r"^v?\d{1,4}(?:[-./:]\w{1,6})+Z?$")
#: Candidates: quoted strings, and runs without spaces and quotes (an apostrophe inside a word is no quote).
CANDIDATE = re.compile(r"\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`|(?:[^\s\"'`]|(?<=[a-z]{2})'(?=(?:t|s|re|ve|ll|d|m)\b))+|[\"'`]")
_JOIN = re.compile(r"\s*(?:\+|\.|\\)?\s*\n?\s*\+?\s*(?=[\"'`])")
#: Parts of a run: a name and its value, the password of an address, what brackets hold.
_PAIR = re.compile(r"(?P<k>[\w.$#\[\]/-]*[\w\])])(?P<op>\|\|=|\?\?=|:=|=>|=|:(?!//))(?P<v>.+)", re.S)
_ADDRESS = re.compile(r"(?<![\w])[A-Za-z][A-Za-z0-9+.-]*://(?P<user>[^\s:/@\"'`]*):(?P<v>[^\s/\"'`<>]+)@[\w.\[-]")
_TRIM = ".,;:)}]>"
#: Parts of strings without evidence that make them an address, a path, a word list, a digest, a blob or a piece of code.
_KNOWN = re.compile(r"://|^[.~]?/|^\w[\w.+-]*@[\w-]+\.|^data:|^(?:[\w.-]+/)+[\w.-]*\.\w{1,5}$|^(?:v?\d+[.-])+|[(){}\[\]<>;]|\\[xu]|^[\w.-]+=[\w.-]*$|^AAAA[A-Z]3|%[0-9A-Fa-f]{2}")
#: Words before a string that tell what else it is.
_SPEAKS = re.compile(r"(?i)(?:sha-?\d*|md5|digest|checksum|hash|integrity|commit|revision|\brev|build|fingerprint|etag|uuid|guid|\bid|_id|public|\bpub|ssh-\w+|ecdsa-\S+|certificate|\bcert|signature|\bsig|blob|base64|version|image|tag|seed|nonce|trace|span|request|session_?id|example|sample|placeholder)[\w.-]*[\"'`\])]*\s*(?:is|=>|:=|[:=@,(])?\s*[\"'`(]?$")
#: Blocks of public keys and certificates.
_BLOCK = re.compile(r"-----BEGIN (?P<what>[A-Z0-9 ]+)-----.*?(?:-----END (?P=what)-----|\Z)", re.S)
_CODE = frozenset("py js ts go jsx tsx java rb rs c h cpp cs php swift kt scala sql css".split())

_LOGS = [0.0, *(k * math.log2(k) for k in range(1, 256))]


def entropy(s: str) -> float:
    n = len(s)
    return math.log2(n) - sum(_LOGS[k] if k < len(_LOGS) else k * math.log2(k) for k in Counter(s).values()) / n if n else 0.0


_DEC, _HEXA = re.compile(r"[0-9]+"), re.compile(r"(?i)[0-9a-f-]+")


def alphabet(s: str) -> int:
    """Size of the smallest usual alphabet of a string."""
    if _HEXA.fullmatch(s):
        return 10 if _DEC.fullmatch(s) else 16
    return 36 if s.islower() or s.isupper() else 64


def threshold(n: int, size: int, evidence: Evidence = Evidence.NONE) -> float:
    """Least entropy, in bits per character, of a credential of ``n`` characters over an alphabet of ``size``."""
    return SHARE[evidence] * math.log2(max(2, min(n, size)))


@functools.lru_cache(maxsize=1)
def letter_pairs() -> np.ndarray:
    """Bits of each letter after another one in common words; 27 x 27, the last row and column for what is no letter."""
    count = np.full((27, 27), 0.5)
    words = lexicon.read()
    for w, rank in words.low.items():
        if w.isascii():
            at = np.array([26, *(ord(c) - 97 for c in w), 26])
            np.add.at(count, (at[:-1], at[1:]), max(1, 16 - rank))
    return -np.log2(count / count.sum(axis=1, keepdims=True))


#: Words whose letters are remembered.
_WORDS = 100_000


_DIGIT = re.compile(r"\d").search


class Letters:
    """Judges letters by the pairs of a public lexicon; words met before are remembered."""

    def __init__(self, pairs: np.ndarray):
        self.pairs = pairs.tolist()
        self.seen: dict[str, float] = {}

    def surprise(self, v: str) -> float:
        """Mean bits per letter."""
        out = self.seen.get(v)
        if out is None:
            at = [26, *(ord(c) - 97 if "a" <= c <= "z" else 26 for c in v.lower()), 26]
            bits = [self.pairs[a][b] for a, b in zip(at, at[1:]) if a != 26 or b != 26]
            if len(self.seen) > _WORDS:
                self.seen.clear()
            out = self.seen[v] = sum(bits) / len(bits) if bits else 0.0
        return out


def is_random(v: str, evidence: Evidence, letters: Letters | None = None) -> bool:
    """Whether the entropy of a value reaches the threshold of its length, alphabet and evidence."""
    n = len(v)
    if n < (LEAST if evidence else UNNAMED) or v.isdigit() or entropy(v) < threshold(n, alphabet(v), evidence):
        return False
    digits = sum(c.isdigit() for c in v)
    if not digits:
        return evidence > 0 and n >= 8 and any(c.isalpha() for c in v) and (letters or usual_letters()).surprise(v) >= threshold_letters(evidence)
    if evidence:
        return digits < n
    kinds = [0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 for c in v]
    changes = [a != b for a, b in zip(kinds, kinds[1:]) if a != 3 and b != 3]
    return digits < n and sum(changes) >= 0.18 * max(1, len(changes))  # words and numbers keep to one kind of character for longer


def possible(v: str, letters: Letters) -> bool:
    """Whether a value would do with the strongest evidence; spares the look at its surroundings."""
    if len(v) < LEAST:
        return False
    if not _DIGIT(v) and (len(v) < 8 or letters.surprise(v) < threshold_letters(Evidence.ISSUER)):
        return False
    return entropy(v) >= threshold(len(v), alphabet(v), Evidence.ISSUER)


@functools.lru_cache(maxsize=1)
def usual_letters() -> Letters:
    return Letters(letter_pairs())


def threshold_letters(evidence: Evidence) -> float:
    return WORDLESS if evidence < Evidence.PLACE else WORDLESS - 0.5


def is_none(v: str) -> bool:
    """Placeholders and references."""
    return len(v) < LEAST or len(set(v)) < 4 or bool(_PLACE.match(v) or _REFER.search(v) or _PUBLIC.match(v))


def _basic(v: str) -> bool:
    """Whether base64 text holds user:password of printable characters."""
    try:
        raw = base64.b64decode(v + "=" * (-len(v) % 4), validate=True).decode("utf-8")
    except (binascii.Error, ValueError):
        return False
    user, sep, word = raw.partition(":")
    return bool(sep) and word.isprintable() and not is_none(word)


def _line(content: str, at: int) -> int:
    return content.rfind("\n", 0, at) + 1


class _Finder:
    """One content's candidates from left to right, with the places of those before in the same line."""

    def __init__(self, content: str, path: str | None, letters: Letters):
        self.text, self.letters = content, letters
        self.code = (path or "").rsplit(".", 1)[-1].lower() in _CODE
        self.found: dict[int, list[tuple[int, int]]] = {}
        self.marks: dict[int, int] = {}
        self.keys = [m.span() for m in PEM.finditer(content)]
        self.blocks: list[tuple[int, int]] | None = None

    def add(self, spans: list[tuple[int, int]]) -> None:
        self.found.setdefault(spans[0][0], spans)

    def run(self) -> list[list[tuple[int, int]]]:
        taken = [self.private_key(a, b) for a, b in self.keys]
        starts: list[int] = []
        line, skip, text = -1, -1, self.text
        for m in CANDIDATE.finditer(text):
            a, b = m.span()
            if a < skip or any(x <= a < y for x, y in taken):
                continue
            if starts and "\n" in text[starts[-1] : a]:
                starts.clear()
            left = starts[-BEFORE] if len(starts) >= BEFORE else starts[0] if starts else a
            if b - a >= LEAST or text[a] in "\"'`" and b - a > 3:
                skip = self.candidate(a, b, left)
            starts.append(a)
        return [self.found[a] for a in sorted(self.found)]

    def private_key(self, a: int, b: int) -> tuple[int, int]:
        rest = self.text[b:]
        end = re.search(r"-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----", rest)
        stop = b + (end.end() if end else len(re.match(r"(?:\s*(?:\\n)?[\"'+#/*]*\s*[A-Za-z0-9+/=]{20,}(?:\\n)?[\"'+]*)*", rest).group()))
        body = re.sub(r"\\n|[^A-Za-z0-9+/=]", "", self.text[b : b + end.start() if end else stop])
        if body and entropy(body) >= threshold(len(body), alphabet(body), Evidence.ISSUER):
            self.add([(a, stop)])
        return a, stop

    def candidate(self, a: int, b: int, left: int) -> int:
        """Judges the candidate ``text[a:b]``; returns where the next one may start."""
        text = self.text
        if text[a] not in "\"'`" or b - a < 2:
            self.bare(a, b, left)
            return b
        before, spans, value, end = text[left:a], [(a + 1, b - 1)], text[a + 1 : b - 1], b
        opened = text[_line(text, a) : a].rstrip().endswith("(") or before.rstrip().endswith("(")
        while text[end : end + 1] and (j := _JOIN.match(text, end)):  # literals that are joined, on this line or the next
            gap = j[0]
            if "+" not in gap and not (("\n" in gap or "\\" in gap) and opened):
                break
            nxt = CANDIDATE.match(text, j.end())
            if not nxt or len(nxt[0]) < 2:
                break
            spans.append((nxt.start() + 1, nxt.end() - 1))
            value += nxt[0][1:-1]
            end = nxt.end()
        if len(spans) == 1 and re.search(r"\s|://|[=:]", value.strip()):
            self.inside(a + 1, b - 1, left)
            if re.search(r"\s", value.strip()):
                return b
        if possible(value, self.letters):
            evidence = self.evidence(before, value, True, a)
            if evidence is not None and self.judge(value, evidence, a, b):
                self.add(spans)
        return end

    def inside(self, a: int, b: int, left: int) -> None:
        """Runs in a quoted text, with what stands before the text as their surroundings too."""
        starts = [left]
        for m in re.finditer(r"[^\s\"'`]+", self.text[a:b]):
            if len(m[0]) >= LEAST:
                self.bare(a + m.start(), a + m.end(), starts[-BEFORE] if len(starts) >= BEFORE else starts[0])
            starts.append(a + m.start())

    def bare(self, a: int, b: int, left: int) -> None:
        text = self.text
        run = text[a:b]
        if "://" in run:
            for m in _ADDRESS.finditer(run):
                if not is_none(m["v"]) and is_random(m["v"], Evidence.PLACE, self.letters):
                    self.add([(a + m.start("v"), a + m.end("v"))])
            if "=" not in run:
                return
        pair = _PAIR.match(run)
        at = a + pair.start("v") if pair else a
        value = text[at:b].lstrip("([{<|")
        at = b - len(value)
        value = value.rstrip(_TRIM)
        if (value[-1:] in "&" or "&" in value) and pair:
            value = value.split("&", 1)[0]
        if pair and not possible(value, self.letters):  # padding is no assignment, and the whole run may be one token
            pair, at, value = None, a, run.rstrip(_TRIM)
        if not possible(value, self.letters):
            return
        if pair and pair["op"] == ":" and USER.search(text[left:a]):
            if not is_none(value) and is_random(value, Evidence.PLACE, self.letters):
                self.add([(at, at + len(value))])
            return
        evidence = self.evidence(text[left:at], value, False, at)
        if evidence is None and pair:
            at, value = a, run.rstrip(_TRIM)
            evidence = self.evidence(text[left:at], value, False, at)
        if evidence is not None and self.judge(value, evidence, at, at + len(value)):
            self.add([(at, at + len(value))])

    def judge(self, value: str, evidence: Evidence, a: int, b: int) -> bool:
        if evidence:
            return is_random(value, evidence, self.letters)
        return is_unnamed(value) and not self.in_block(a) and not _SPEAKS.search(self.text[max(_line(self.text, a), a - 80) : a]) and not _blob(self.text, a, b)

    def in_block(self, at: int) -> bool:
        if self.blocks is None:
            self.blocks = [m.span() for m in _BLOCK.finditer(self.text)]
        return any(x <= at < y for x, y in self.blocks)

    def evidence(self, before: str, value: str, quoted: bool, at: int) -> Evidence | None:
        """What the surroundings say; None if they say that the value is another thing."""
        if is_none(value):
            return None
        if len(value) > 15 and ISSUED.search(value):
            return Evidence.ISSUER
        scheme = SCHEME.search(before)
        if scheme:
            head = before[: scheme.start()].rstrip("\"'` ")
            if scheme["scheme"].lower() == "basic":
                return Evidence.PLACE if _basic(value) else None
            if scheme["scheme"][0].isupper() or HEADER.search(head + " ") or ASSIGNED.search(head):
                return Evidence.PLACE
        if USER.search(before) and ":" in value:
            return None
        header = HEADER.search(before)
        if FLAG.search(before) and not value.startswith("-") or header and header[0][:2].lower() == "x-":
            return Evidence.PLACE
        m = ASSIGNED.search(before)
        if m and not (m["op"] == "," and not m["close"]):
            if _names_other(m["rest"], value):
                return None
            if quoted or not self.code or m["op"] == ":" and _in_comment(self.text, at, self.marks):
                return Evidence.NAME
            return None  # code on the right of an assignment is no literal
        row = TABLE.search(before)
        if row and not _names_other(row["rest"], value):
            return Evidence.NAME
        if quoted and PROSE.search(before):
            return Evidence.NAME
        if not quoted and (not self.code or _in_comment(self.text, at, self.marks)) and PROSE_BARE.search(before) and any(c.isdigit() for c in value):
            return Evidence.NAME
        return Evidence.NONE if len(value) >= UNNAMED else None


def find(content: str | None, path: str | None = None, letters: Letters | None = None) -> list[list[tuple[int, int]]]:
    """Spans of each credential, sorted by their first start; several spans if it is split."""
    if not content or not content.strip():
        return []
    return _Finder(content, path, letters or usual_letters()).run()


#: A line that is one encoded run, as wide as encoders write them; the last of a block may be shorter.
_ROW, _LAST = re.compile(r"\s*[\"'`]?[A-Za-z0-9+/_=-]{56,}[\"'`]?[\\,;+)\s]*$"), re.compile(r"\s*[\"'`]?[A-Za-z0-9+/_=-]+[\"'`]?[\\,;+)\s]*$")
_SHORT = re.compile(r"\s*([\"'`])[A-Za-z0-9+/_=-]{8,}\1[\\;+)\s]*$|" + _ROW.pattern)
#: Lines around a string in which such a line makes it part of a blob; others may have been put between.
AROUND = 3


def is_unnamed(v: str) -> bool:
    """Whether a string is random enough without a name, and nothing else that is random."""
    return len(v) < BLOB and is_random(v, Evidence.NONE) and not (is_none(v) or _HEX.match(v) or _UUID.search(v) or _KNOWN.search(v) or any(map(_HEX.match, re.split(r"[^A-Za-z0-9]+", v))))


def _names_other(rest: str, v: str) -> bool:
    """Whether what follows the credential word in a name makes it another thing, or the value is a date or version."""
    return bool(rest) and bool(OTHER.search(rest) or _WHEN.match(v))


def _blob(content: str, a: int, b: int) -> bool:
    """Whether a string stands alone in its line and one of the lines around it is an encoded run too."""
    start, end = content.rfind("\n", 0, a) + 1, content.find("\n", b)
    end = len(content) if end < 0 else end
    if not _LAST.match(content, start, end):
        return False
    x, y = start, end
    for _ in range(AROUND):
        x, y = content.rfind("\n", 0, max(0, x - 1)) + 1, content.find("\n", y + 1) if y < len(content) else y
        y = len(content) if y < 0 else y
    kind = _SHORT if _ROW.match(content, start, end) else _ROW  # a row's neighbour may be the short last one
    return any(kind.match(line) for line in content[x : max(x, start - 1)].split("\n") + content[end + 1 : y].split("\n"))


_COMMENT = re.compile(r"(?:(?<=\s)|^)(?:#|//|/\*|\*|--|<!--)", re.M)


def _in_comment(content: str, at: int, first: dict[int, int]) -> bool:
    """Whether a comment mark stands before ``at`` in its line; ``first`` remembers each line's first mark."""
    start = content.rfind("\n", 0, at) + 1
    if start not in first:
        end = content.find("\n", start)
        m = _COMMENT.search(content, start, len(content) if end < 0 else end)
        first[start] = m.end() if m else len(content) + 1
    return first[start] <= at


MASK = "[REDACTED]"


def redact(content: str | None, path: str | None = None, letters: Letters | None = None) -> str | None:
    """The content with each credential replaced; quotes, line breaks and everything around it stay."""
    if not content:
        return content
    out, at = [], 0
    for spans in find(content, path, letters):
        for a, b in spans:
            body = content[a:b]
            head = PEM.match(body)
            if head:  # header and footer stay, the lines between are replaced one by one
                tail = re.search(r"-----END [A-Z0-9 ]*-----$", body)
                inner = body[head.end() : tail.start() if tail else len(body)]
                mask = head[0] + re.sub(r"[A-Za-z0-9+/=]{8,}", MASK, inner) + (tail[0] if tail else "")
            else:
                mask = MASK
            out += [content[at:a], mask]
            at = b
    return "".join([*out, content[at:]])


def files(records: DataFrame, key: str = "skill_id", column: str = "package_files") -> DataFrame:
    """``(key, path, content)`` of each file with content, repeated ones once."""
    f = records.where(F.col(key).isNotNull()).select(key, F.explode(column).alias("f"))
    return f.select(key, F.col("f.path").alias("path"), F.col("f.content").alias("content")).where("content is not null and trim(content) != ''")


def credential_lines(fs: DataFrame, key: str = "skill_id") -> DataFrame:
    """``(key, path, line_no)`` of each credential; repeated files count once."""
    kind, pairs = fs.schema[key].dataType.simpleString(), letter_pairs()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters(pairs)
        for b in batches:
            at, lines = [], []
            for i, (p, c) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                for spans in find(c, p, letters):
                    at.append(i)
                    lines.append(c.count("\n", 0, spans[0][0]) + 1)
            rows = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows), pa.array(lines, pa.int64())], [key, "path", "line_no"])

    return fs.select(key, "path", "content").mapInArrow(run, f"`{key}` {kind}, path string, line_no bigint").distinct()


def redacted_files(fs: DataFrame, key: str = "skill_id") -> DataFrame:
    """``(key, path, content, redacted, n)``: files with their credentials replaced and how many there were."""
    kind, pairs = fs.schema[key].dataType.simpleString(), letter_pairs()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters(pairs)
        for b in batches:
            pc = list(zip(b.column(1).to_pylist(), b.column(2).to_pylist()))
            n = [len(find(c, p, letters)) for p, c in pc]
            red = [redact(c, p, letters) if k else c for (p, c), k in zip(pc, n)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(red, pa.string()), pa.array(n, pa.int32())], [key, "path", "redacted", "n"])

    return fs.select(key, "path", "content").mapInArrow(run, f"`{key}` {kind}, path string, redacted string, n int")
