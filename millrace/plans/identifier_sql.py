"""SQL for the places, choice and splice of identifiers (DuckDB dialect).

Offsets follow from running sums over the pieces between matches, overlaps from a recursive walk; both are apart from what the operator does.
"""

from __future__ import annotations

from millrace.operators import identifiers as i
from millrace.plans import sql as q

_WORD = r"\p{L}\p{M}\p{N}\p{Pc}"


def _pattern(p: str, lines: bool) -> str:
    """A pattern in RE2's terms: letters of any script, ``$`` and ``^`` at line ends where asked."""
    p = p.replace(r"[\w.]", f"[{_WORD}.]").replace(r"[\w-]", f"[{_WORD}-]").replace(r"[\w.-]", f"[{_WORD}.-]").replace(r"[\w.\-+]", rf"[{_WORD}.\-+]").replace(r"[@\w./-]", f"[@{_WORD}./-]").replace('\\"', '"')
    return ("(?m)" if lines else "") + p.replace("'", "''")


def _table(d: dict[str, str]) -> str:
    return "(values " + ", ".join(f"('{k}', '{v}')" for k, v in d.items()) + ")"


def _made_up(name: str, kind: str) -> str:
    return f"({name}) || ({i.ENDINGS!r})[1 + cast('0x' || substr(sha1('{kind}|' || ({name})), 1, 2) as int) % {len(i.ENDINGS)}]"


_STANDARD = ", ".join(f"'{w}'" for w in i.STANDARD)
_BARE = "case when k like '@%' then string_split(regexp_replace(k, '^@+', ''), '/')[-1] else k end"


def _first(whole: str, old: str, new: str) -> str:
    return f"substr({whole}, 1, instr({whole}, {old}) - 1) || {new} || substr({whole}, instr({whole}, {old}) + length({old}))"


def _hits(name: str, pattern: str, groups: int, lines: bool, key: str, table: dict[str, str], kind: str, package: str | None, made: str, repl: str) -> str:
    """CTEs that end in ``hit_{name}`` (skill_id, stage, layer, s, e, repl, kind). ``package`` is what must look like a package for a made-up
    name, null for none; ``new`` stands for the chosen name in ``repl``."""
    p = _pattern(pattern, lines)
    cols = ", ".join(f"unnest(regexp_extract_all(inn, '{p}', {g})) g{g}" for g in range(groups + 1))
    known = f"{kind}" if kind != "env_var" else "env_var"
    ok = "false" if package is None else f"coalesce(regexp_full_match({package}, '[a-z][a-z0-9_-]{{2,}}') and {package} not in ({_STANDARD}), false)" if package != "true" else "true"
    return f"""raw_{name} as (select skill_id, stage, layer, {cols}, unnest(string_split_regex(inn, '{p}')) b, unnest(range(1, len(string_split_regex(inn, '{p}')) + 1)) o from lay),
 at_{name} as (select *, {key} k, sum(length(b) + coalesce(length(g0), 0)) over (partition by skill_id, stage, layer order by o) e from raw_{name}),
 new_{name} as (select a.*, coalesce(d.v, case when {ok} then {_made_up(made, kind)} end) new, case when d.v is not null then '{known}' when {ok} then '{kind}_generic' end kind from at_{name} a left join {_table(table)} d(c, v) on d.c = a.k where g0 is not null),
 hit_{name} as (select skill_id, stage, layer, cast(e - length(g0) as int) s, cast(e as int) e, {repl} repl, kind from new_{name} where kind is not null)"""


_TOP = "lower(string_split(g3, '.')[1])"
_ALL = [
    ("import", i.IMPORT, 3, True, _TOP, i.PIP, "py_import", "k", "k", "g1 || g2 || ' ' || new || substr(g3, length(k) + 1)"),
    ("pin", i.PIN, 3, True, "lower(g1)", i.PIP, "pip_pin", "k", "k", "new || g2 || g3"),
    ("dep", i.DEPENDENCY, 1, False, "lower(g1)", i.NPM, "npm_dep", _BARE, "g1", _first("g0", "('\"' || g1 || '\"')", "'\"' || new || '\"'")),
    ("req", i.REQUIRE, 1, False, "lower(g1)", i.NPM, "js_require", _BARE, "g1", _first("g0", "g1", "new")),
    ("npm", i.NPM_COMMAND, 3, False, "lower(g3)", i.NPM, "npm_cmd", _BARE, "g3", "concat_ws(' ', g1, g2, new)"),
    ("pip", i.PIP_COMMAND, 1, False, "lower(g1)", i.PIP, "pip_cmd", "k", "k", "'pip install ' || new"),
    ("flag", i.FLAG, 0, False, "g0", i.FLAGS, "cli_flag", "true", "g0", "new"),
    ("env", i.VARIABLE, 1, False, "g1", i.VARIABLES, "env_var", None, "g1", "new"),
]
_TAG = {"I": "INSTRUCTION", "R": "RESOURCE", "M": "METADATA"}
_INN = lambda x: f"coalesce(regexp_extract(text, '(?s)<{_TAG[x]}>\\n(.*?)\\n</{_TAG[x]}>', 1), '')"


def places(source: str) -> str:
    """CTEs that end in ``hits`` (skill_id, stage, layer, s, e, repl, kind, without overlaps) from ``lay`` (skill_id, stage, layer, inn), which ``source`` defines."""
    every = " union all ".join(f"select * from hit_{h[0]}" for h in _ALL)
    walk = f"""every as ({every}), num as (select *, row_number() over (partition by skill_id, stage, layer order by s, e, repl, kind) j from every),
 walk as (select skill_id, stage, layer, s, e, repl, kind, j, e till, true keep from num where j = 1 union all
  select n.skill_id, n.stage, n.layer, n.s, n.e, n.repl, n.kind, n.j, case when n.s >= w.till then n.e else w.till end, n.s >= w.till from walk w join num n on n.skill_id = w.skill_id and n.stage = w.stage and n.layer = w.layer and n.j = w.j + 1),
 hits as (select skill_id, stage, layer, s, e, repl, kind from walk where keep)"""
    return f"{source}, " + ", ".join(_hits(*h) for h in _ALL) + ", " + walk


LAYERS = f"""{q.SAMPLES}, lay0 as (select skill_id, stage, 'I' layer, {_INN('I')} inn from samples union all select skill_id, stage, 'R', {_INN('R')} from samples where stage = 'stage2'), lay as (select * from lay0 where trim(inn, ' ') <> '')"""
PLACES = "with recursive " + places(LAYERS)
_M, _I, _R = (f"case when {_INN(x)} = '' then '' else '<{_TAG[x]}>' || chr(10) || {_INN(x)} || chr(10) || '</{_TAG[x]}>' end" for x in "MIR")
_NEW = lambda x: f"'<{_TAG[x]}>' || chr(10) || inn2 || chr(10) || '</{_TAG[x]}>'"
SUBSTITUTED = (
    PLACES
    + f""", ranked as (select *, row_number() over (partition by skill_id, stage, layer order by sha1(concat_ws('|', 't3c', skill_id, layer, cast(s as varchar))), s, e, repl, kind) rk from hits),
 few as (select *, lag(e, 1, 0) over (partition by skill_id, stage, layer order by s) till from ranked where rk <= 3),
 put as (select l.skill_id, l.stage, l.layer, string_agg(substr(inn, till + 1, s - till) || repl, '' order by s) || substr(any_value(inn), max(e) + 1) inn2, count(*) n, string_agg(kind, ',' order by s) kinds from few join lay l using (skill_id, stage, layer) group by 1, 2, 3),
 whole as (select p.skill_id, p.stage, s.split, 'layer=' || layer || '|method=rule|registry_v={i.REGISTRY_VERSION}|k=' || p.n || '|kinds=' || kinds sub, layer target,
   case when p.stage = 'stage1' then {q.join_parts(_M, _NEW('I'))} else {q.join_parts(_M, f"case when layer = 'I' then {_NEW('I')} else {_I} end", f"case when layer = 'R' then {_NEW('R')} else {_R} end")} end text
   from put p join samples s on s.skill_id = p.skill_id and s.stage = p.stage)"""
)
DOCUMENTS = "with recursive " + places("lay as (select doc_id skill_id, '' stage, '' layer, text inn from documents where text is not null)")
