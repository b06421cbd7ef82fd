"""SQL fragments for the independent statements of the queries (DuckDB dialect)."""

from __future__ import annotations

_TAIL = r"\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WS, WS_LINE = r"[\t-\r" + _TAIL, r"[\t\x0b-\r" + _TAIL
NL = "chr(10)"
MARK = f"({NL}||{NL}||'[TRUNCATED]')"


def rstrip(x: str) -> str:
    return f"regexp_replace({x}, '{WS}+$', '')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def clean(x: str) -> str:
    t = f"replace(replace(coalesce({x}, ''), chr(13)||chr(10), chr(10)), chr(13), chr(10))"
    t = f"regexp_replace(regexp_replace({t}, '[ \\t]+', ' ', 'g'), '{WS_LINE}+\\n', {NL}, 'g')"
    return f"regexp_replace({strip(t)}, '\\n{{3,}}', {NL}||{NL}, 'g')"


def clip(x: str, n: str | int) -> str:
    """``x`` should be a column name, as it is repeated."""
    head = rstrip(f"substr({x}, 1, {n})")
    return f"case when {n} <= 0 or length({x}) <= {n} then {x} else (case when length({head}) + 13 > {n} then {rstrip(f'substr({head}, 1, greatest(0, {n} - 13))')} else {head} end) || {MARK} end"


def tokens(x: str) -> str:
    return f"cast((length({x}) + 3) // 4 as bigint)"


def wrap(x: str, tag: str) -> str:
    return f"case when {x} = '' then '' else '<{tag}>' || {NL} || {x} || {NL} || '</{tag}>' end"


def join_parts(*parts: str) -> str:
    return f"concat_ws({NL}, {', '.join(f'nullif({p}, {chr(39) * 2})' for p in parts)})"


def hex_long(h: str, at: int, n: int = 8) -> str:
    return f"cast('0x' || substr({h}, {at}, {n}) as bigint)"


def sha1_mod(x: str, m: int = 1_000_000) -> str:
    acc = "0"
    for i in range(5):
        acc = f"(({acc} * {2**32 % m} + {hex_long(f'sha1({x})', 1 + 8 * i)}) % {m})"
    return acc


def digest_mod(n: str, *parts: str) -> str:
    h = f"sha1(concat_ws('|', {', '.join(parts)}))"
    return f"((({hex_long(h, 1)} % ({n})) * (4294967296 % ({n})) + {hex_long(h, 9)}) % ({n}))"


POOL = f"case when {sha1_mod(chr(39) + '20260501|' + chr(39) + ' || skill_id')} / 1000000.0 < 0.5 then 'unseen' else 'cpt' end"
SPLIT = (
    f"case when {sha1_mod(chr(39) + '20260501|' + chr(39) + ' || skill_id')} / 1000000.0 < 0.5 then 'unseen' "
    f"when {sha1_mod(chr(39) + '20260502|' + chr(39) + ' || skill_id')} / 1000000.0 < 0.8 then 'train' when {sha1_mod(chr(39) + '20260502|' + chr(39) + ' || skill_id')} / 1000000.0 < 0.9 then 'val' else 'test' end"
)

#: One row per skill: repeated records hold the same content.
SKILLS = "skills as (select * from (select *, row_number() over (partition by skill_id order by ingested_at) rn from normalized_skill_records where skill_id is not null) where rn = 1)"
#: Files of each skill in order, cleaned.
FILES = f"""files as (select skill_id, i, {clean('f.path')} path, {clean('f.content')} content, coalesce(f.truncated, false) was, coalesce(f.size_bytes, 0) size_bytes from
 (select skill_id, unnest(package_files) f, unnest(range(1, len(package_files) + 1)) i from skills) where f is not null)"""
BLOCK = strip(f"'### ' || case when path = '' then 'unknown' else path end || {NL} || content")
SAMPLES = f"""{SKILLS}, {FILES},
 res as (select skill_id, string_agg(b, {NL}||{NL} order by i) body, count(*) n from (select skill_id, i, {BLOCK} b from files where path <> '' or content <> '') group by 1),
 cols as (select s.skill_id, {clean('name')} nm, {clean('description_text')} ds, {clean('skill_md_non_description')} ins, coalesce(res.body, '') rs, coalesce(n, 0) n,
   greatest(coalesce(text_char_count, 0), coalesce(package_files_total_bytes, 0)) size from skills s left join res on res.skill_id = s.skill_id),
 secs as (select skill_id, n, case when nm = '' and ds = '' then '' else '<METADATA>' || {NL} || concat_ws({NL}, case when nm <> '' then 'name: ' || nm end, case when ds <> '' then 'description: ' || ds end) || {NL} || '</METADATA>' end m,
   {wrap('ins', 'INSTRUCTION')} i, {wrap('rs', 'RESOURCE')} r from cols where size <= 256000),
 both_ as (select skill_id, 'stage1' stage, m, i, '' r, 0 n, {join_parts('m', 'i')} text from secs union all select skill_id, 'stage2', m, i, r, n, {join_parts('m', 'i', 'r')} from secs where r <> ''),
 samples as (select *, {POOL} pool, {SPLIT} split from both_ where text <> '' and {tokens('text')} <= case when stage = 'stage1' then 4096 else 10240 end)"""
POOLS = """pools as (select stage, pool, skill_id, row_number() over (partition by stage, pool order by case split when 'train' then 0 when 'val' then 1 when 'test' then 2 else 3 end, skill_id) - 1 pos from samples),
 sizes as (select stage, pool, count(*) size from pools group by all)"""


def donors(requests: str, name: str = "picked", seed: int = 20260601) -> str:
    """CTE ``name`` from a CTE ``requests`` (skill_id, stage, pool, pattern, k, n)."""
    h = f"sha1(concat_ws('|', '{seed}', skill_id, pattern, cast(k as varchar)))"
    start = digest_mod("size", f"'{seed}'", "skill_id", "pattern", "cast(k as varchar)")
    return f"""walk_{name} as (select r.*, size, {start} start, case when ({hex_long(h, 1)} | 1) % size = 0 then 1 else {hex_long(h, 1)} | 1 end step from {requests} r join sizes using (stage, pool)),
 met_{name} as (select w.skill_id, w.stage, w.pool, w.pattern, w.k, w.n, p.skill_id donor, min(j) j from walk_{name} w, (values (0), (1), (2)) t(j), pools p
   where p.stage = w.stage and p.pool = w.pool and p.pos = (w.start + j * (w.step % w.size)) % w.size and p.skill_id <> w.skill_id group by all),
 {name} as (select skill_id, stage, pool, pattern, k, n, list(donor order by j)[1:n] donors from met_{name} group by skill_id, stage, pool, pattern, k, n having count(*) >= n)"""
