"""Files that nobody wrote by hand: tool output, minified files, third-party copies, data kept as code (problem 2).

Every file of a programming, style or query language is first judged by the layout of its content against the limits of its language
(``LIMITS``): maximum and mean line length, share of white space, share of letters and digits, density of numeric and string literals,
share of long encoded runs, and share of lines with the commonest shape. Minified code is sought in the dense lines alone, so that
local additions don't hide it. Layout can't tell a copied or generated file that looks like source, so what it lets
pass is judged by three more signs: directories of third-party code, lock files and source maps, and what comments state of
their own file. A statement counts only in a comment and only about the file; strings, other subjects and license headers do not.

Null or blank content and null paths are never found; a path may be written with ``\\`` or a leading ``./``. Repeated files
count once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

# Extensions of programming, style and query languages.
CODE = frozenset("py js mjs cjs ts jsx tsx go sh bash rb pl php lua r jl java kt scala swift rs c h cc cpp hpp cs m sql css scss less vue dart ex exs clj hs ml ps1 d".split())


class Limits(NamedTuple):
    """Limits of a language, beyond what people write in it."""

    dense: int = 120  #: length from which a line is dense if it has little white space
    tight: float = 0.0  #: greatest share of white space of dense lines; 0 where lines can't be joined
    mean: float = 200  #: mean line length of a file that is one dense block
    longest: int = 400  #: line length that makes half the encoded share enough
    alnum: float = 0.88  #: greatest share of letters and digits in code; walls of text have more
    numeric: float = 0.30  #: share of numeric literals
    encoded: float = 0.5  #: share of encoded runs
    literal: float = 0.55  #: share of literals in lines of one shape
    same: float = 0.75  #: share of lines of one shape


# Limits by language. Style sheets and scripts are minified most, languages with layout rules can't be.
_SCRIPT, _STYLE, _BRACES, _LAYOUT, _SHELL = Limits(tight=0.075), Limits(tight=0.06, alnum=0.9), Limits(tight=0.07, dense=160), Limits(numeric=0.24), Limits(same=0.8, encoded=0.45)
LIMITS = {
    **dict.fromkeys("js mjs cjs ts jsx tsx vue".split(), _SCRIPT), **dict.fromkeys("css scss less".split(), _STYLE), **dict.fromkeys("php java c h cc cpp hpp cs rs kt scala swift dart d".split(), _BRACES), "go": _BRACES._replace(longest=300),
    **dict.fromkeys("py rb jl r lua ex exs clj hs ml".split(), _LAYOUT), **dict.fromkeys("sh bash ps1 pl".split(), _SHELL), "sql": Limits(same=0.7, literal=0.2, numeric=0.2),
}
#: Characters of dense lines from which a file is minified, and their least share of it; dense lines in a row that may be shorter, and how long they are at least.
DENSE, DENSE_SHARE, ROW, ROW_LENGTH = 300, 0.3, 4, 60
#: Least share of signs in minified code.
SIGNS = 0.12
#: Lines of one shape that make a table.
TABLE = 8
# Directories of third-party code.
FOREIGN = frozenset("node_modules vendor _vendor vendored third_party third-party thirdparty 3rdparty external externals bower_components site-packages jspm_packages pods".split())
# Names of lock files.
LOCKS = re.compile(r"(?i)(?:^|[-_.])lock(?:file)?(?:\.(?:json|yaml|yml|toml|hcl))?$|^(?:go\.sum|npm-shrinkwrap\.json|packages\.lock\.json|composer\.lock|gemfile\.lock)$")
LOCKED = re.compile(r"lockfileVersion|\"integrity\"|integrity[: ]+\"?sha\d|resolved \"|content-hash|checksum = |\[\[package\]\]|_meta|\"resolved\"|h1:[A-Za-z0-9+/=]{20}|DEPENDENCIES")
VERSION, MAPPINGS = re.compile(r"\"version\"\s*:\s*3\b"), re.compile(r"\"mappings\"\s*:")

_BY_TOOL = r"(?:generated|created|produced|written|emitted|built|compiled|exported|transpiled|rendered)"
#: What a head comment says of its file, from the start of the comment on.
MADE = re.compile(
    rf"(?i)^(?:@|<)?\s*(?:(?:auto-?|machine-?|tool-?)?generated|(?:auto-?|machine-?|tool-?)(?:written|made|produced))\b(?!\s+(?:ids?|names?|files? are|values?|code is)\b)(?:\s+(?:by|from|with|using|on|at|via|file|code|automatically|at)\b|\s*[/>.:;,!-]|\s*$)"
    rf"|^(?:this|the)\s+(?:file|code|module|source|document|script|class|schema|header)\s+(?:is|was|has been|were)\s+(?:auto-?\s?|automatically\s+|machine-?\s?)?{_BY_TOOL}\b"
    rf"|^(?:code|file|source|automatically|autogenerated)\s+(?:auto-?|automatically\s+)?{_BY_TOOL}\b"
    rf"|^(?:do not|don't|never) (?:edit|modify|change)\b|\b(?:manual|hand|local)(?:ly)?[ -](?:edits?|changes?|modifications?)\b.*\b(?:overwritten|lost|discarded|undone|reverted)\b|^output of (?:the|a) \w+|^(?:re-?generate|run .* to regenerate)\b"
    r"|^(?:archivo|fichero|código|arquivo) (?:auto)?(?:generado|gerado)|^(?:generado|gerado) (?:autom|por)|^(?:fichier|code) (?:auto-?)?(?:produit|généré)|^généré (?:par|auto)"
    r"|^(?:automatisch|maschinell) (?:erzeugt|generiert|erstellt)|^(?:generiert|erzeugt) (?:von|aus|durch)|^diese datei wurde|^自動生成|^自动生成|^此文件(?:由|是)|^このファイルは自動|^(?:автоматически|файл создан)|^file generato|^자동 생성"
)
COPIED = re.compile(
    r"(?i)^!?\s*[@\w./-]+(?:\.js|\.css|\.py)?\s+v?\d+(?:\.\d+)+\s*(?:[-|–—:*,]|\().*(?:upstream|copied|copy of|vendored|licen[cs]ed?|released|unchanged)"
    r"|^(?:vendored|copied|taken|imported|bundled)\s+(?:\w+\s+)?(?:unchanged\s+|verbatim\s+)?(?:from|copy|in from)|^(?:upstream|third[- ]party) (?:copy|release|code|source|library)|^this (?:file|code|module) (?:is|was) (?:vendored|copied|taken|imported)"
)
_MARK = re.compile(r"^\s*(?:/\*+!?|//+!?|#+|--+|\*+|<!--|;+|\"\"\"|'''|%+|\(\*|<)\s*")
_NOTE = re.compile(r"(?i)^(?:note|nb|warning|caution|attention|important|notice)\s*[:!–-]+\s*(?=\w)")
_END = re.compile(r"\s*(?:\*/|-->|\"\"\"|''')\s*")
_WORD, _NUM, _STR = re.compile(r"[^\W\d_]\w*"), re.compile(r"(?<![\w.])-?(?:0[xX][0-9a-fA-F]+|\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)(?![\w.])"), re.compile(r"\"[^\"\n]*\"|'[^'\n]*'")
_SHAPE_NUM = re.compile(r"\d+(?:\.\d+)?")
_RUN = re.compile(r"[A-Za-z0-9+/=_-]{40,}|(?:\\x[0-9a-fA-F]{2}){16,}|(?:0x[0-9a-fA-F]{2},\s*){8,}")
# Marks between which block comments stand.
_BLOCKS = (("/*", "*/"), ("<!--", "-->"), ('"""', '"""'), ("'''", "'''"), ("(*", "*)"), ("--[[", "]]"))
#: Statements that are about the file wherever they stand, and code before which any statement is.
STRONG = re.compile(
    r"(?i)^(?:@generated|<auto-?generated)|^(?:this|the)\s+(?:file|module|source|document|script|schema|header)\s|^(?:code|file|source|automatically)\s+(?:auto-?|automatically\s+)?generated\s+by|^(?:auto-?|machine-?)?generated (?:file|code|automatically|by [\w./-]+(?: v?\d|[.;,]? do not))"
    r"|^(?:auto-?|machine-?|tool-?)(?:written|made|produced|generated) (?:by|from|with)|\b(?:manual|hand|local)(?:ly)?[ -](?:edits?|changes?|modifications?)\b.*\b(?:overwritten|lost|discarded|undone|reverted)\b"
    r"|generated\b.*\b(?:do not|don't|never) (?:edit|modify|change)\b|^(?:auto-?)?generated by .*\b(?:compiler|generator)\b"
    r"|^(?:do not|don't|never) (?:edit|modify|change)\W*(?:$|this file|by hand|manually|directly)|^[^\x00-\x7f]|^(?:diese datei|automatisch (?:erzeugt|generiert)|fichier |archivo |fichero |arquivo )"
)
_OPENS = re.compile(r"\s*(?:import|from|package|use|using|require|include|#\s*include|#\s*pragma|module|namespace|library|@charset|'use strict'|\"use strict\"|syntax)\b|\s*$|[#/*\s-]+source: \S")
_HEREDOC = re.compile(r"<<[-~]?\s*[\"']?([A-Za-z_]\w*)[\"']?")
_PEM = re.compile(r"-----BEGIN [A-Z ]+-----.*?(?:-----END [A-Z ]+-----|\Z)", re.S)
_BUNDLE = re.compile(r"/\*{4,}/(?=[ \t]*\S)|__webpack_require__\s*[(.]|__modules__\s*=|System\.register\(|define\.amd")


def layout(content: str) -> dict[str, float]:
    """Layout statistics of a content."""
    lines = content.split("\n")
    full = [x for x in lines if x.strip()]
    n = max(1, len(content))
    numbers = sum(map(len, _NUM.findall(content)))
    shapes = Counter(_SHAPE_NUM.sub("0", _WORD.sub("w", _STR.sub("s", x.strip()))) for x in full)
    return {
        "lines": len(full),
        "longest": max(map(len, lines)),
        "mean": sum(map(len, full)) / max(1, len(full)),
        "space": sum(map(str.isspace, content)) / n,
        "alnum": sum(map(str.isalnum, content)) / n,
        "numeric": numbers / n,
        "literal": (numbers + sum(map(len, _STR.findall(content)))) / n,
        "encoded": sum(map(len, _RUN.findall(content))) / n,
        "same": max(shapes.values(), default=0) / max(1, len(full)),
    }


def _dense(content: str, m: Limits) -> str:
    """Dense lines of a content: long ones with little white space, and shorter such ones in a row."""
    out, row = [], []
    for line in [*content.split("\n"), ""]:
        tight = len(line) >= ROW_LENGTH and sum(map(str.isspace, line)) <= m.tight * len(line)
        if tight:
            row.append(line)
            continue
        out += row if len(row) >= ROW else [x for x in row if len(x) >= m.dense]
        row = []
    return "".join(out)


def layout_reason(path: str | None, content: str | None) -> str | None:
    """What the layout alone tells of a file of a programming, style or query language."""
    ext = _extension(path)
    if ext not in CODE or not content or not content.strip():
        return None
    content = _PEM.sub("", content)  # a key in a file doesn't make the file data
    m, x = LIMITS.get(ext, Limits()), layout(content)
    if x["encoded"] > m.encoded or x["encoded"] > m.encoded / 2 and x["longest"] > m.longest or x["numeric"] > m.numeric or x["alnum"] > m.alnum and x["mean"] > m.mean:
        return "data"
    body = _dense(content, m) if m.tight else ""
    if m.tight and x["mean"] > m.mean and x["space"] <= m.tight:
        body = content
    if body and len(body) >= min(DENSE, 0.6 * len(content)) and (len(body) >= DENSE_SHARE * len(content) or len(body) >= 4 * DENSE):
        if sum(map(str.isdigit, body)) > 0.3 * len(body):
            return "data"
        if 1 - sum(c.isalnum() or c.isspace() for c in body) / len(body) > SIGNS:
            return "minified"
    if x["lines"] >= TABLE and x["same"] >= m.same:
        return "data" if x["literal"] > m.literal or x["numeric"] > 0.08 or ext == "sql" else "tool"
    return None


def _extension(path: str | None) -> str:
    name = re.split(r"[/\\]+", (path or "").strip())[-1]
    return name.rsplit(".", 1)[-1].lower() if "." in name else ""


def _statements(content: str) -> Iterator[tuple[str, bool]]:
    """Comment texts with whether they can be about the file only by what they say. Read are the comments before the first code, with the
    lines of block comments and docstrings, and after it those that aren't indented, whatever the number of lines; strings over several lines are passed over."""
    lines = content.split("\n")
    last = {x.strip(): k for k, x in enumerate(lines)} | {q: k for q in ('"""', "'''", "`") for k, x in enumerate(lines) if q in x}  # where a string may end
    end, text, code, loud = "", False, False, True  # mark that ends a block or string, whether that is a comment, code seen, whether the last text ended a sentence
    for k, line in enumerate(lines):
        parts = re.split(r"(?<=\*/)\s*(?=//|/\*)", line)
        for part in parts:
            bare = part.strip()
            if end:
                if text and bare:
                    m = _MARK.match(part)
                    said = _END.sub("", part[m.end() if m else 0 :]).strip()
                    if said and (loud or not said[0].islower()):
                        yield said, code
                    loud = not said or said[-1] in ".!?:;"
                if end in part if not end.isidentifier() else bare == end:
                    end, loud = "", True
                continue
            opened = next((x for x in _BLOCKS if bare.startswith(x[0])), None)
            m = _MARK.match(part)
            deep = code
            if m and not (deep and part[:1].isspace()):
                said = _END.sub("", part[m.end() :]).strip()
                weak = deep and not _OPENS.match(next((x for x in lines[k + 1 : k + 2]), ""))
                if said and (loud or not deep or not said[0].islower()):
                    yield said, weak
                    if bare.startswith("<"):
                        yield bare, weak
                loud = not said or said[-1] in ".!?:;" or bool(opened and opened[1] in bare[len(opened[0]) :])
            else:
                loud = True
            if opened:
                if opened[1] not in bare[len(opened[0]) :]:
                    end, text = opened[1], not (deep and part[:1].isspace())
            elif bare and not m:
                code = True
                for q in ('"""', "'''", "`"):
                    if bare.count(q) % 2 and last.get(q, 0) > k:
                        end, text = q, False
                        break
                else:
                    h = _HEREDOC.search(bare)
                    if h and last.get(h[1], 0) > k:
                        end, text = h[1], False


def _bundled(content: str) -> bool:
    """Whether a mark of a bundle stands in the code, not in a string or comment."""
    for m in _BUNDLE.finditer(content):
        before = content[content.rfind("\n", 0, m.start()) + 1 : m.start()]
        if not re.search(r"//|^\s*[#*]|/\*(?!.*\*/)", before) and not any(before.count(q) % 2 for q in "\"'`"):
            return True
    return False


def stated_reason(path: str | None, content: str | None) -> tuple[str, str] | None:
    """What place, name, statements and marks tell of a file: the reason, and which of place and statement gave it."""
    if path is None or not content or not content.strip():
        return None
    parts = [p for p in re.split(r"[/\\]+", path.strip()) if p not in ("", ".", "..")]
    name = parts[-1] if parts else ""
    ext = _extension(path)
    if any(p.lower() in FOREIGN for p in parts[:-1]):
        return "third_party", "place"
    if LOCKS.search(name) and (LOCKED.search(content) or ext == "lock"):
        return "tool", "place"
    if ext == "map" and VERSION.search(content) and MAPPINGS.search(content):
        return "tool", "place"
    if ext not in ("md", "rst", "txt", "adoc"):
        said = [(_NOTE.sub("", s), weak) for s, weak in _statements(content)]
        if any(MADE.search(s) and (not weak or STRONG.search(s)) for s, weak in said):
            return "tool", "statement"
        if any(COPIED.search(s) for s, _ in said):
            return "third_party", "statement"
    if ext in CODE and _bundled(content):
        return "tool", "statement"
    return None


def judged(path: str | None, content: str | None) -> tuple[str, str] | None:
    """Why a file isn't hand-written (tool, minified, third_party or data) and what told it (layout, place or statement); None if it is."""
    if path is None:
        return None
    why = layout_reason(path, content)
    return (why, "layout") if why else stated_reason(path, content)


def reason(path: str | None, content: str | None) -> str | None:
    found = judged(path, content)
    return found[0] if found else None


def made_files(fs: DataFrame, key: str = "skill_id") -> DataFrame:
    """``(key, path, reason, found_by)`` of the files of ``fs`` (key, path, content) that aren't hand-written."""
    kind = fs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [judged(p, c) or (None, None) for p, c in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            why, by = (pa.array([f[k] for f in found], pa.string()) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), why, by], [key, "path", "reason", "found_by"]).filter(why.is_valid())

    return fs.select(key, "path", "content").mapInArrow(run, f"`{key}` {kind}, path string, reason string, found_by string").distinct()
