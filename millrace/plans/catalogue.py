"""Queries of the core operators over the test tables, and independent SQL for them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import hashing, text
from millrace.operators import balance, challenge, identifiers, normalize, positions, samples, spans, stats, variants, verdicts
from millrace.plans import identifier_sql as ids
from millrace.plans import sql as q
from millrace.session import cut, load, prepare
from millrace.sources import readers
from millrace.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(statement: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        def run(spark: SparkSession, d: str) -> DataFrame:
            prepare(spark)
            return f(spark, d)

        QUERIES[f.__name__] = run
        if statement:
            ORACLE_SQL[f.__name__] = statement
        return run

    return add


# --- views over the test tables -------------------------------------------------------------------------------------


#: Columns that phase-1 samples are made of.
_SAMPLE = ("name", "description_text", "skill_md_non_description", "package_files", "text_char_count", "package_files_total_bytes")


def skills(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """One row per skill with the given columns; repeated records hold the same content, so the first by time is taken. Only these
    columns are read and shuffled; the rows of a skill are sorted by it, as the engine has no hashed minimum over texts."""
    df = load(spark, d, "normalized_skill_records").where("skill_id is not null")
    if not columns:
        return df.select("skill_id").distinct()
    one = df.groupBy("skill_id").agg(F.min_by(F.struct(*columns), "ingested_at").alias("x"))
    return one.select("skill_id", *(F.col(f"x.{c}").alias(c) for c in columns))


def canonical(spark: SparkSession, d: str) -> DataFrame:
    s = skills(spark, d, "name", "first_layer_description", "has_explicit_description_heading", "skill_md_description", "skill_md_non_description", "package_files")
    section = F.struct(F.col("has_explicit_description_heading").alias("found"), F.lit("Description").alias("heading"), F.col("skill_md_description").alias("content"))
    return s.select("skill_id", F.struct("name", F.col("first_layer_description").alias("description")).alias("first_layer"), F.struct(section.alias("description_section"), F.col("skill_md_non_description").alias("non_description")).alias("skill_md"), "package_files")


def phase1(spark: SparkSession, d: str) -> DataFrame:
    return samples.phase1(skills(spark, d, *_SAMPLE))


def written(spark: SparkSession, d: str) -> DataFrame:
    """Samples as a written table, as the variant operators read them several times."""
    return cut(phase1(spark, d).select("skill_id", "stage", "pool", "split", "text", "metadata_text", "instruction_text", "resource_text"))


def verdict_rows(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "verdicts")


def index(spark: SparkSession, d: str) -> DataFrame:
    return readers.verdict_index(verdict_rows(spark, d), [F.col("scanned_at")])


def judged(spark: SparkSession, d: str, policy: verdicts.Policy = verdicts.Policy()) -> DataFrame:
    v, small = verdicts.counted_index(index(spark, d))
    return verdicts.judge(load(spark, d, "normalized_skill_records").select("skill_id"), v, policy, small)


def variant_table(spark: SparkSession, d: str) -> DataFrame:
    """variant_rows with clean keys; repeated rows once."""
    v = load(spark, d, "variant_rows").drop("built_at")
    low = lambda c: F.lower(F.trim(c)).alias(c)
    names = ("label", "split", "stage", "anchor_skill_id")
    return v.select(*(low(c) if c in names else F.col(c) for c in v.columns)).distinct()


def bad_ids(spark: SparkSession, d: str) -> DataFrame:
    """A hold-out for the scrub queries: skills with a malicious verdict."""
    return index(spark, d).where("overall_class = 'MALICIOUS'").select("skill_id")


_INDEX = """ix as (select id skill_id, arg_max(oc, k) oc, arg_max(ac, k) ac from (select trim(skill_id, ' ') id, upper(trim(coalesce(overall_class, ''), ' ')) oc, upper(trim(coalesce(alignment_class, ''), ' ')) ac,
  upper(trim(coalesce(static_rule_class, ''), ' ')) sc, upper(trim(coalesce(llm_filter_class, ''), ' ')) lc, upper(trim(coalesce(behavioral_class, ''), ' ')) bc, row(scanned_at, oc, ac, sc, lc, bc) k from verdicts) where id is not null and id <> '' group by 1)"""
_JUDGED = f"""{_INDEX}, jd as (select r.skill_id, ix.skill_id is not null scanned, coalesce(oc in ('MALICIOUS', 'SUSPICIOUS'), false) bo, coalesce(ac in ('MISALIGNED'), false) ba from normalized_skill_records r left join ix on ix.skill_id = r.skill_id)"""
_V = "v as (select distinct sample_id, lower(trim(anchor_skill_id, ' ')) anchor_skill_id, lower(trim(label, ' ')) label, sub_strategy, target_layer, source_skill_ids, text, text_chars, text_tokens_est, pool, lower(trim(split, ' ')) split, lower(trim(stage, ' ')) stage, normalized_version, phase1_output_version, output_version from variant_rows)"
_BAD = f"{_INDEX}, bad as (select skill_id from ix where oc = 'MALICIOUS')"


# --- flagship: scan, verdict filter, clean, sections, budget, split, count ------------------------------------------


@query(f"""with {_INDEX}, {q.SAMPLES}, kept as (select s.* from samples s left join ix on ix.skill_id = s.skill_id where ix.skill_id is null or not (oc in ('MALICIOUS', 'SUSPICIOUS') or ac in ('MISALIGNED')))
select pool, split, stage, count(*) as n_rows, cast(sum({q.tokens('text')}) as bigint) as tokens from kept group by all""")
def verdict_pool_split_counts(spark: SparkSession, d: str) -> DataFrame:
    v, small = verdicts.counted_index(index(spark, d))
    kept = verdicts.judge(skills(spark, d, *_SAMPLE), v, verdicts.Policy(), small).where("keep")
    return samples.phase1(kept).groupBy("pool", "split", "stage").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("total_tokens_est").alias("tokens"))


# --- verdicts ---------------------------------------------------------------------------------------------------------

_REPORT = "cast(count_if(scanned and {keep}) as bigint) as kept, cast(count_if(bo) as bigint) as excluded_by_overall, cast(count_if(ba) as bigint) as excluded_by_alignment, cast(count_if(bo or ba) as bigint) as excluded_by_either, {uk} as unscanned_kept, {ud} as unscanned_dropped"


@query(f"with {_JUDGED} select " + _REPORT.format(keep="not (bo or ba)", uk="cast(count_if(not scanned) as bigint)", ud="cast(0 as bigint)") + " from jd")
def verdict_filter_report(spark: SparkSession, d: str) -> DataFrame:
    return verdicts.report(judged(spark, d))


@query(f"with {_JUDGED} select skill_id from jd where not (bo or ba)")
def verdict_keep_rows(spark: SparkSession, d: str) -> DataFrame:
    return judged(spark, d).where("keep").select("skill_id")


@query(f"with {_JUDGED} select " + _REPORT.format(keep="not (bo or ba)", uk="cast(0 as bigint)", ud="cast(count_if(not scanned) as bigint)") + " from jd")
def verdict_strict_unscanned(spark: SparkSession, d: str) -> DataFrame:
    return verdicts.report(judged(spark, d, verdicts.Policy(keep_unscanned=False)))


@query(f"with {_JUDGED} select skill_id from jd where not bo")
def verdict_overall_only(spark: SparkSession, d: str) -> DataFrame:
    return judged(spark, d, verdicts.Policy(alignment=())).where("keep").select("skill_id")


@query(f"with {_JUDGED} select skill_id from jd where bo or ba")
def excluded_ids(spark: SparkSession, d: str) -> DataFrame:
    return verdicts.excluded_ids(judged(spark, d))


@query(f"with {_INDEX} select skill_id, oc as overall_class, ac as alignment_class from ix")
def verdict_index(spark: SparkSession, d: str) -> DataFrame:
    return index(spark, d).select("skill_id", "overall_class", "alignment_class")


# --- text ---------------------------------------------------------------------------------------------------------------


@query(f"select doc_id, md5(t) as text_md5, cast(length(t) as int) as chars from (select doc_id, {q.clean('text')} t from documents)")
def clean_text_docs(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").select("doc_id", text.clean(F.col("text")).alias("t")).select("doc_id", F.md5("t").alias("text_md5"), F.length("t").alias("chars"))


@query(f"select doc_id, md5({q.clip('t', 200)}) as text_md5, length(t) > 200 as clipped from (select doc_id, {q.clean('text')} t from documents)")
def truncate_docs(spark: SparkSession, d: str) -> DataFrame:
    t = load(spark, d, "documents").select("doc_id", text.clean(F.col("text")).alias("t"))
    return t.select("doc_id", F.md5(text.clip(F.col("t"), 200)).alias("text_md5"), text.is_clipped(F.col("t"), 200).alias("clipped"))


@query(f"select source, count(*) as n_docs, cast(sum({q.tokens('text')}) as bigint) as tokens from documents group by 1")
def token_estimate(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(text.tokens(F.col("text"))).alias("tokens"))


_L = lambda tag: f"coalesce(regexp_extract(text, '(?s)<{tag}>\\n(.*?)\\n</{tag}>', 1), '')"


@query("select sample_id, " + ", ".join(f"md5({_L(tag)}) as {x.lower()}" for x, tag in text.TAGS.items()) + " from variant_rows")
def extract_layer(spark: SparkSession, d: str) -> DataFrame:
    v = load(spark, d, "variant_rows")
    return v.select("sample_id", *(F.md5(text.layer_of(F.col("text"), x)).alias(x.lower()) for x in text.TAGS))


def _swap_sql(stage: str, layer: str) -> str:
    parts = ", ".join(f"{'upper(' if x == layer else ''}{_L(text.TAGS[x])}{')' if x == layer else ''} {x.lower()}" for x in text.LAYERS[stage])
    return f"select sample_id, '{layer}' layer, md5({q.join_parts(*(q.wrap(x.lower(), text.TAGS[x]) for x in text.LAYERS[stage]))}) as swapped from (select sample_id, {parts} from variant_rows where text is not null and lower(trim(stage, ' ')) = '{stage}')"


@query(" union all ".join(_swap_sql(s, x) for s, xs in text.LAYERS.items() for x in xs))
def swap_layer(spark: SparkSession, d: str) -> DataFrame:
    """Each layer of both stages replaced by its upper-case form."""
    v = load(spark, d, "variant_rows").where("text is not null").withColumn("stage", text.strip(F.lower("stage")))
    one = lambda s, x: F.struct(F.lit(x).alias("layer"), F.md5(text.replace_layer(F.col("text"), s, x, F.upper(text.layer_of(F.col("text"), x)))).alias("swapped"))
    rows = F.when(F.col("stage") == "stage1", F.array(*(one("stage1", x) for x in text.LAYERS["stage1"]))).when(F.col("stage") == "stage2", F.array(*(one("stage2", x) for x in text.LAYERS["stage2"])))
    return v.select("sample_id", F.explode(rows).alias("x")).select("sample_id", "x.*")


# --- normalize ----------------------------------------------------------------------------------------------------------


@query(f"""with {q.SKILLS}, t as (select {q.clean('skill_md_description')} a, {q.clean('first_layer_description')} b from skills)
select case when a <> '' then 'skill_md_heading' when b <> '' then 'first_layer_description' else 'empty' end as description_source, count(*) as n_rows, cast(sum(length(case when a <> '' then a else b end)) as bigint) as chars from t group by 1""")
def description_source(spark: SparkSession, d: str) -> DataFrame:
    n = normalize.normalize(canonical(spark, d))
    return n.groupBy("description_source").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("description_text")).alias("chars"))


_FULL = f"""{q.SKILLS}, {q.FILES}, pk as (select skill_id, {q.clean(f"string_agg(b, {q.NL}||{q.NL} order by i)")} p from (select skill_id, i, {q.BLOCK} b from files where path <> '' or content <> '') group by 1),
 t as (select s.skill_id, {q.clean('name')} n, {q.clean('first_layer_description')} f, {q.clean('skill_md_description')} m, {q.clean('skill_md_non_description')} r, coalesce(p, '') p from skills s left join pk on pk.skill_id = s.skill_id),
 u as (select skill_id, {q.strip(f"concat_ws({q.NL}||{q.NL}, case when n <> '' then '# Skill Name' || {q.NL} || n end, case when f <> '' then '# First Layer Description' || {q.NL} || f end, case when m <> '' then '# Effective Description' || {q.NL} || m when f <> '' then '# Effective Description' || {q.NL} || f end, case when r <> '' then '# Remaining Skill Markdown' || {q.NL} || r end, case when p <> '' then '# Package Files' || {q.NL} || p end)")} x from t)"""


@query(f"with {_FULL} select skill_id, md5(x) as text_md5, cast(length(x) as int) as chars from u")
def full_text(spark: SparkSession, d: str) -> DataFrame:
    n = normalize.normalize(canonical(spark, d), concat_chars=10_000_000)
    return n.select("skill_id", F.md5("full_text").alias("text_md5"), F.length("full_text").alias("chars"))


def _pack(name: str, chars: int, total: int) -> Query:
    def f(spark: SparkSession, d: str) -> DataFrame:
        n = normalize.normalize(canonical(spark, d), file_chars=chars, concat_chars=total)
        return n.select("skill_id", F.md5("package_files_text").alias("packed_md5"), F.col("package_files_count").alias("n_files"), F.col("package_files_total_bytes").alias("total_bytes"), F.col("package_files_truncated_count").alias("truncated"))

    f.__name__ = name
    return query(f"""with recursive {q.SKILLS}, {q.FILES}, c as (select *, {q.clip('content', chars)} cc, was or length(content) > {chars} t from files),
 b as (select skill_id, row_number() over (partition by skill_id order by i) j, {q.BLOCK.replace('|| content', '|| cc')} b, t from c where path <> '' or cc <> ''),
 rec as (select skill_id, cast(0 as bigint) j, cast({total} as bigint) rest, cast('' as varchar) txt, cast(0 as bigint) n, cast(0 as bigint) k from skills union all
  select r.skill_id, r.j + 1, case when r.rest > 0 then r.rest - length({q.clip('b.b', 'r.rest')}) - 2 else r.rest end, case when r.rest > 0 then r.txt || case when r.k > 0 then {q.NL}||{q.NL} else '' end || {q.clip('b.b', 'r.rest')} else r.txt end,
   r.n + case when r.rest > 0 and length(b.b) > r.rest and not b.t then 1 else 0 end, r.k + case when r.rest > 0 then 1 else 0 end from rec r join b on b.skill_id = r.skill_id and b.j = r.j + 1),
 last as (select skill_id, arg_max(txt, j) txt, max(n) n from rec group by 1),
 a as (select skill_id, count(*) files, sum(size_bytes) bytes, count_if(t) cut from c group by 1)
select l.skill_id, md5({q.strip('txt')}) as packed_md5, coalesce(files, 0) as n_files, cast(coalesce(bytes, 0) as bigint) as total_bytes, cast(coalesce(cut, 0) + n as bigint) as truncated from last l left join a on a.skill_id = l.skill_id""")(f)


#: With the operator's own budgets, and with small ones that most packages exceed.
package_budget_pack, package_budget_small = _pack("package_budget_pack", normalize.FILE_CHARS, normalize.CONCAT_CHARS), _pack("package_budget_small", 300, 1200)


@query()
def record_sha1_exact(spark: SparkSession, d: str) -> DataFrame:
    return normalize.record_sha1(normalize.normalize(canonical(spark, d))).select("skill_id", "record_sha1")


_CUT_FULL = _FULL.replace(", pk as (", f", c as (select * exclude (content), {q.clip('content', 12000)} content, was or length(content) > 12000 t from files), pk as (", 1).replace("from files where path", "from c where path", 1)


@query(f"""with {_CUT_FULL}, a as (select count(*) files, sum(size_bytes) bytes, count_if(t) cut from c), r as (select count(*) n, avg(length(x)) mc from u)
select n as "rows", cast(files as bigint) as files, cast(bytes as bigint) as bytes, cast(cut as bigint) as truncated, cast((select count_if({q.clean('skill_md_description')} = '' and {q.clean('first_layer_description')} <> '') from skills) as bigint) as fallbacks,
 cast((select count_if(has_explicit_description_heading) from skills) as bigint) as headings, round(mc, 6) as mean_chars, round(files / n, 6) as mean_files from a, r""")
def normalize_report(spark: SparkSession, d: str) -> DataFrame:
    return normalize.report(normalize.normalize(canonical(spark, d))).withColumns({c: F.round(c, 6) for c in ("mean_chars", "mean_files")})


# --- samples ------------------------------------------------------------------------------------------------------------


@query(f"with {q.SAMPLES} select skill_id, md5(m) as m_md5, md5(i) as i_md5 from secs")
def metadata_instruction_sections(spark: SparkSession, d: str) -> DataFrame:
    return samples.sections(samples.small_enough(skills(spark, d, *_SAMPLE))).select("skill_id", F.md5("m").alias("m_md5"), F.md5("i").alias("i_md5"))


@query(f"""with recursive {q.SKILLS}, {q.FILES}, c as (select *, {q.clip('content', 300)} cc, length(content) > 300 t from files where path <> '' or content <> ''),
 b as (select skill_id, row_number() over (partition by skill_id order by i) j, {q.BLOCK.replace('|| content', '|| cc')} b, t from c),
 rec as (select skill_id, cast(0 as bigint) j, cast(1000 as bigint) rest, cast('' as varchar) txt, cast(0 as bigint) k, cast(0 as bigint) dr, cast(0 as bigint) cut from skills union all
  select skill_id, j + 1, case when ok then rest - length(bb) - case when k > 0 then 2 else 0 end else rest end, case when ok then txt || case when k > 0 then {q.NL}||{q.NL} else '' end || bb else txt end, k + ok::int, dr + (not ok)::int, cut + (ok and (t or length(b) > room))::int from
  (select *, rest > 0 and room > 0 and bb <> '' ok from (select *, {q.clip('b', 'room')} bb from (select r.*, b.b, b.t, case when k = 0 then rest else rest - 2 end room from rec r join b on b.skill_id = r.skill_id and b.j = r.j + 1)))),
 last as (select skill_id, arg_max(row(txt, k, dr, cut), j) x from rec group by 1)
select skill_id, md5(case when x[2] = 0 then '' else '<RESOURCE>' || {q.NL} || x[1] || {q.NL} || '</RESOURCE>' end) as r_md5, cast(x[2] as int) as included, cast(x[3] as int) as dropped, cast(case when x[2] = 0 then 0 else x[4] end as int) as truncated from last""")
def resource_section(spark: SparkSession, d: str) -> DataFrame:
    s = skills(spark, d, "package_files").select("skill_id", samples.resource_section(F.col("package_files"), 300, 1000).alias("r"))
    return s.select("skill_id", F.md5("r.text").alias("r_md5"), "r.included", "r.dropped", "r.truncated")


def _stage(stage: str) -> Query:
    def f(spark: SparkSession, d: str) -> DataFrame:
        p = phase1(spark, d).where(F.col("stage") == stage)
        return p.select("sample_id", "skill_id", F.md5("text").alias("text_md5"), "total_tokens_est", "pool", "split", F.col("n_resource_files_included").alias("n_files"))

    f.__name__ = f"phase1_samples_{stage}"
    return query(f"with {q.SAMPLES} select sha1(concat_ws('|', stage, skill_id, substr(text, 1, 128))) as sample_id, skill_id, md5(text) as text_md5, {q.tokens('text')} as total_tokens_est, pool, split, cast(n as int) as n_files from samples where stage = '{stage}'")(f)


phase1_samples_stage1, phase1_samples_stage2 = _stage("stage1"), _stage("stage2")


@query(f"with {q.SKILLS} select skill_id from skills where greatest(coalesce(text_char_count, 0), coalesce(package_files_total_bytes, 0)) <= 256000")
def phase1_oversize_filter(spark: SparkSession, d: str) -> DataFrame:
    return samples.small_enough(skills(spark, d, "text_char_count", "package_files_total_bytes")).select("skill_id")


@query(f"""with {q.SAMPLES}, f as (select skill_id, m <> '' or i <> '' any_, {q.tokens(q.join_parts('m', 'i'))} <= 1000 o, r <> '' and {q.tokens(q.join_parts('m', 'i', 'r'))} <= 1500 t from secs)
select cast(count_if(any_ and o or t) as bigint) as "any", cast(count_if(any_ and o) as bigint) as stage1, cast(count_if(t) as bigint) as stage2, cast(count_if(not (any_ and o or t)) as bigint) as "none", (select count(*) from skills) - count(*) as oversize from f""")
def phase1_emit_counts(spark: SparkSession, d: str) -> DataFrame:
    return samples.emit_counts(skills(spark, d, *_SAMPLE), samples.Budgets(stage1_tokens=1000, stage2_tokens=1500))


@query(f"with {q.SKILLS} select skill_id, {q.POOL} as pool, {q.SPLIT} as split from skills")
def pool_split_assign(spark: SparkSession, d: str) -> DataFrame:
    pool, split = hashing.pool_and_split(F.col("skill_id"))
    return skills(spark, d).select("skill_id", pool.alias("pool"), split.alias("split"))


@query(f"with {q.SAMPLES} select stage, split, count(*) as n_rows from samples group by all")
def split_counts(spark: SparkSession, d: str) -> DataFrame:
    return phase1(spark, d).groupBy("stage", "split").agg(F.count(F.lit(1)).alias("n_rows"))


@query(f"with {q.SKILLS}, p as (select skill_id, {q.hex_long('sha1(' + chr(39) + '20260423:' + chr(39) + ' || skill_id)', 1)} / 4294967295.0 p from skills) select skill_id, case when p < 0.9 then 'train' when p < 0.95 then 'val' else 'test' end as split from p")
def legacy_split_assign(spark: SparkSession, d: str) -> DataFrame:
    return skills(spark, d).select("skill_id", hashing.legacy_split(F.col("skill_id"), 20260423, 0.9, 0.05).alias("split"))


@query(f"with {q.SAMPLES} select stage, split, round(avg(length(m)), 6) as mean_m, max(length(m)) as max_m, round(avg(length(r)), 6) as mean_r, max(length(r)) as max_r, round(avg({q.tokens('text')}), 6) as mean_tokens, max({q.tokens('text')}) as max_tokens from samples group by all")
def section_mean_max(spark: SparkSession, d: str) -> DataFrame:
    s = samples.section_sizes(phase1(spark, d))
    r = lambda c: F.round(c, 6)
    return s.select("stage", "split", r("mean_metadata_chars").alias("mean_m"), F.col("max_metadata_chars").alias("max_m"), r("mean_resource_chars").alias("mean_r"), F.col("max_resource_chars").alias("max_r"), r("mean_total_tokens_est").alias("mean_tokens"), F.col("max_total_tokens_est").alias("max_tokens"))


# --- donors and variants --------------------------------------------------------------------------------------------


@query(f"with {q.SAMPLES} select stage, pool, count(*) as n_rows from samples group by all")
def donor_pool_sizes(spark: SparkSession, d: str) -> DataFrame:
    return variants.pool_sizes(phase1(spark, d)).withColumnRenamed("rows", "n_rows")


@query(f"with {q.SAMPLES}, {q.POOLS} select stage, pool, skill_id, pos from pools")
def donor_positions(spark: SparkSession, d: str) -> DataFrame:
    return variants.donor_pools(written(spark, d))


_PATTERNS = "(values " + ", ".join(f"('{s}', '{p}', {2 if 'C' in m.values() else 1}, '{'+'.join(sorted(m))}')" for s, t in variants.T2.items() for p, m in t.items()) + ") p(stage, pattern, n, target)"
_T2_REQ = f"req as (select s.skill_id, s.stage, s.pool, p.pattern, k, p.n from samples s join {_PATTERNS} on p.stage = s.stage, (values (0), (1)) t(k))"
_PICKED = f"{q.SAMPLES}, {q.POOLS}, {_T2_REQ}, {q.donors('req')}"


def _assigned(n: int) -> Query:
    def f(spark: SparkSession, d: str) -> DataFrame:
        s = written(spark, d)
        out = variants.donors(variants.donor_requests(s).where(F.col("n") == n), variants.donor_pools(s), variants.Config().seed)
        return out.select("skill_id", "stage", "pattern", "k", F.array_join("donors", ",").alias("donors"))

    f.__name__ = f"donor_assignment_k{n}"
    return query(f"with {_PICKED} select skill_id, stage, pattern, k, array_to_string(donors, ',') as donors from picked where n = {n}")(f)


donor_assignment_k1, donor_assignment_k2 = _assigned(1), _assigned(2)


def _row_sql(label: str, cte: str) -> str:
    return f"select sha1(concat_ws('|', '{label}', sub, skill_id, substr(text, 1, 128))) as sample_id, skill_id as anchor_skill_id, stage, split, sub as sub_strategy, target as target_layer, md5(text) as text_md5, cast(length(text) as int) as chars from {cte} where text <> '' and {q.tokens('text')} <= case when stage = 'stage1' then 4096 else 10240 end"


def _row(v: DataFrame) -> DataFrame:
    return v.select("sample_id", "anchor_skill_id", "stage", "split", "sub_strategy", "target_layer", F.md5("text").alias("text_md5"), F.col("text_chars").cast("int").alias("chars"))


_T1 = " union all ".join(f"select skill_id, stage, split, 'order={'>'.join(o)}' sub, '' target, {q.join_parts(*(x.lower() for x in o))} text from samples where stage = '{s}'" for s, os in variants.T1.items() for o in os)
_LAYER = {"A": "s", "B": "b", "C": "c"}
_T2_TEXT = "case " + " ".join(f"when p.stage = '{s}' and p.pattern = '{p}' then {q.join_parts(*(f'{_LAYER[m.get(x, chr(65))]}.{x.lower()}' for x in text.LAYERS[s]))}" for s, t in variants.T2.items() for p, m in t.items()) + " end"
_T2 = f"""{_PICKED}, t2 as (select p.skill_id, p.stage, s.split, p.pattern || '|k=' || p.k || '|donors=' || array_to_string(p.donors, ',') sub, pt.target, {_T2_TEXT} text from picked p join samples s on s.skill_id = p.skill_id and s.stage = p.stage
 join {_PATTERNS.replace(') p(', ') pt(')} on pt.stage = p.stage and pt.pattern = p.pattern left join samples b on b.skill_id = p.donors[1] and b.stage = p.stage left join samples c on c.skill_id = p.donors[2] and c.stage = p.stage)"""


@query(f"with {q.SAMPLES}, t1 as ({_T1}) {_row_sql('T1', 't1')}")
def t1_permutations(spark: SparkSession, d: str) -> DataFrame:
    return _row(variants.permuted(phase1(spark, d)))


@query(f"with {_T2} {_row_sql('T2', 't2')}")
def t2_swaps(spark: SparkSession, d: str) -> DataFrame:
    return _row(variants.swapped(written(spark, d)))


@query(f"with {_T2}, r as ({_row_sql('T2', 't2')}) select stage, target_layer, count(*) as n_rows from r group by all")
def t2_target_layer_counts(spark: SparkSession, d: str) -> DataFrame:
    return variants.label_counts(variants.swapped(written(spark, d)), ("stage", "target_layer")).withColumnRenamed("rows", "n_rows")


_INNER = lambda c, tag: f"coalesce(nullif(regexp_extract({c}, '(?s)^<{tag}>\\n(.*)\\n</{tag}>$', 1), ''), {c})"
_SPAN = f"""{q.SAMPLES}, {q.POOLS}, sreq as (select s.skill_id, s.stage, s.pool, p.pattern, k, 1 n from samples s join (values ('stage1', 't3b_I'), ('stage2', 't3b_I'), ('stage2', 't3b_R')) p(stage, pattern) on p.stage = s.stage, (values (0), (1)) t(k)), {q.donors('sreq', 'sp')},
 s0 as (select p.skill_id, p.stage, s.split, p.k, p.donors[1] donor, substr(p.pattern, 5, 1) layer, s.m, s.i, s.r, case when p.pattern = 't3b_I' then {_INNER('s.i', 'INSTRUCTION')} else {_INNER('s.r', 'RESOURCE')} end own, case when p.pattern = 't3b_I' then {_INNER('b.i', 'INSTRUCTION')} else {_INNER('b.r', 'RESOURCE')} end other
  from sp p join samples s on s.skill_id = p.skill_id and s.stage = p.stage join samples b on b.skill_id = p.donors[1] and b.stage = p.stage),
 s1 as (select *, least(greatest(200, cast(floor(length(own) * 0.15::double) as int)), 1500, length(own), length(other)) len from s0),
 s2 as (select *, {q.digest_mod('length(own) - len + 1', "'20260601'", "'t3b_span'", 'skill_id', 'layer', 'cast(k as varchar)', "'a'")} a, {q.digest_mod('length(other) - len + 1', "'20260601'", "'t3b_span'", 'skill_id', 'layer', 'cast(k as varchar)', "'d'")} dd from s1 where len >= 200),
 s3 as (select *, substr(own, 1, a) || substr(other, dd + 1, len) || substr(own, a + len + 1) nw from s2),
 s4 as (select skill_id, stage, split, 'layer=' || layer || '|k=' || k || '|donor=' || donor || '|frac=0.15' sub, layer target, {q.join_parts('m', "case when layer = 'I' then '<INSTRUCTION>' || chr(10) || nw || chr(10) || '</INSTRUCTION>' else i end", "case when stage = 'stage1' then '' when layer = 'R' then '<RESOURCE>' || chr(10) || nw || chr(10) || '</RESOURCE>' else r end")} text from s3)"""


@query(f"with {_SPAN} {_row_sql('T3b', 's4')}")
def t3b_span_swap(spark: SparkSession, d: str) -> DataFrame:
    return _row(variants.spliced(written(spark, d)))


@query()
def t3b_span_swap_mt(spark: SparkSession, d: str) -> DataFrame:
    return _row(variants.spliced(written(spark, d), rng="mt"))


@query(f"with {_SPAN}, {_T2_REQ}, {q.donors('req')}, t1 as ({_T1}), t2 as ({_T2.split(', t2 as (', 1)[1][:-1]}), every as (select stage, split, 'positive' label from samples union all select stage, split, 'T1' from ({_row_sql('T1', 't1')}) union all select stage, split, 'T2' from ({_row_sql('T2', 't2')}) union all select stage, split, 'T3b' from ({_row_sql('T3b', 's4')})) select stage, split, label, count(*) as n_rows from every group by all")
def variants_label_counts(spark: SparkSession, d: str) -> DataFrame:
    return variants.label_counts(variants.variants(written(spark, d))).withColumnRenamed("rows", "n_rows")


@query(f"with {q.SAMPLES}, t1 as ({_T1}) select stage, count(*) as n_rows from t1 where {q.tokens('text')} <= case when stage = 'stage1' then 500 else 900 end group by 1")
def variant_budget_drop(spark: SparkSession, d: str) -> DataFrame:
    c = variants.Config(max_tokens={"stage1": 500, "stage2": 900})
    return variants.permuted(phase1(spark, d), c).groupBy("stage").agg(F.count(F.lit(1)).alias("n_rows"))


# --- identifiers and spans ------------------------------------------------------------------------------------------


def _positives(spark: SparkSession, d: str) -> DataFrame:
    return variants.positive(phase1(spark, d))


@query(f"{ids.PLACES} select skill_id as anchor_skill_id, stage, layer, s as start, e as \"end\", repl, kind from hits")
def t3c_hits(spark: SparkSession, d: str) -> DataFrame:
    rows = identifiers.layer_rows(_positives(spark, d).select("anchor_skill_id", "text", "stage"))
    h = rows.withColumn("h", identifiers.find_places(F.col("inner"))).select("anchor_skill_id", "stage", "layer", F.explode("h").alias("h"))
    return h.select("anchor_skill_id", "stage", "layer", "h.*")


@query(f"{ids.PLACES} select stage, layer, kind, count(*) as n_hits from hits group by all")
def t3c_hit_kind_counts(spark: SparkSession, d: str) -> DataFrame:
    return t3c_hits(spark, d).groupBy("stage", "layer", "kind").agg(F.count(F.lit(1)).alias("n_hits"))


@query(f"{ids.SUBSTITUTED} {_row_sql('T3c', 'whole')}")
def t3c_substitutions(spark: SparkSession, d: str) -> DataFrame:
    return _row(identifiers.substituted(_positives(spark, d)))


@query(f"""{ids.SUBSTITUTED}, l2 as (select l.*, s.split from lay0 l join samples s on s.skill_id = l.skill_id and s.stage = l.stage),
 o as (select l2.stage, l2.split, l2.layer, case when trim(l2.inn, ' ') = '' then 'empty_layer' when w.text is null then 'no_hit' when {q.tokens('w.text')} > case when l2.stage = 'stage1' then 4096 else 10240 end then 'over_budget' else 'emitted' end outcome
  from l2 left join whole w on w.skill_id = l2.skill_id and w.stage = l2.stage and w.target = l2.layer)
select stage, split, layer, outcome, count(*) as n_layers from o group by all""")
def t3c_outcomes(spark: SparkSession, d: str) -> DataFrame:
    return identifiers.outcomes(identifiers.attempts(_positives(spark, d)))


@query()
def t3a_outcomes(spark: SparkSession, d: str) -> DataFrame:
    return identifiers.outcomes(spans.attempts(_positives(spark, d)))


@query(f"{ids.DOCUMENTS} select repl as replacement, kind, count(*) as n from hits where kind = 'env_var' group by all")
def curated_env_subs(spark: SparkSession, d: str) -> DataFrame:
    t = load(spark, d, "documents").where("text is not null").select(F.explode(identifiers.find_places(F.col("text"))).alias("h"))
    return t.where("h.kind = 'env_var'").groupBy(F.col("h.repl").alias("replacement"), "h.kind").agg(F.count(F.lit(1)).alias("n"))


@query(f"{ids.DOCUMENTS} select kind, count(*) as n, count(distinct repl) as n_names, min(repl) as first_name from hits group by 1")
def document_identifiers(spark: SparkSession, d: str) -> DataFrame:
    t = load(spark, d, "documents").where("text is not null").select(F.explode(identifiers.find_places(F.col("text"))).alias("h"))
    return t.groupBy("h.kind").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("h.repl").alias("n_names"), F.min("h.repl").alias("first_name"))


@query(f"with n as (select distinct name from normalized_skill_records where name is not null) select name, name || ({identifiers.ENDINGS!r})[1 + cast('0x' || substr(sha1('pip_pin|' || name), 1, 2) as int) % 7] as fake from n")
def generic_suffix(spark: SparkSession, d: str) -> DataFrame:
    n = load(spark, d, "normalized_skill_records").where("name is not null").select("name").distinct()
    return n.select("name", identifiers.made_up(F.col("name"), "pip_pin").alias("fake"))


def _scores(patterns: list[str]) -> Query:
    return lambda spark, d: spans.line_scores(skills(spark, d, "skill_md_non_description"), "skill_id", "skill_md_non_description", patterns).groupBy("skill_id").agg(F.sum("score").cast("bigint").alias("score"), F.count(F.lit(1)).alias("n_lines"))


def _score_sql(patterns: list[str]) -> str:
    one = lambda p: "len(regexp_extract_all(line, '" + p.replace("'", "''").replace('\\"', '"').replace(r"\w+\(", r"[\p{L}\p{N}\p{M}_]+\(").replace(r"\d", r"\p{Nd}") + "'))"
    return f"""with {q.SKILLS}, l as (select skill_id, unnest(string_split(skill_md_non_description, chr(10))) line from skills where skill_md_non_description is not null)
select skill_id, cast(sum(case when regexp_matches(line, '^{q.WS}*$') then 0 else {" + ".join(map(one, patterns))} end) as bigint) as score, count(*) as n_lines from l group by 1"""


@query(_score_sql(spans.BEHAVIOUR))
def line_scores_t3a(spark: SparkSession, d: str) -> DataFrame:
    return _scores(spans.BEHAVIOUR)(spark, d)


@query(_score_sql(spans.REFERENCES))
def line_scores_t3c(spark: SparkSession, d: str) -> DataFrame:
    return _scores(spans.REFERENCES)(spark, d)


@query(f"""with {q.SKILLS}, l as (select skill_id, unnest(string_split(skill_md_non_description, chr(10))) line, unnest(range(0, len(string_split(skill_md_non_description, chr(10))))) no from skills where skill_md_non_description is not null),
 s as (select skill_id, no, case when regexp_matches(line, '^{q.WS}*$') then 0 else len(regexp_extract_all(line, '--[a-z]')) end + 1 sc from l),
 w as (select skill_id, no as start, sum(sc) over (partition by skill_id order by no rows between current row and 7 following) score, count(*) over (partition by skill_id) n from s)
select skill_id, cast(start as int) as start, cast(least(start + 8, n) as int) as stop, cast(score as double) as score from w where start = 0 or start + 8 <= n""")
def span_window_scores(spark: SparkSession, d: str) -> DataFrame:
    return spans.span_windows(skills(spark, d, "skill_md_non_description"), "skill_id", "skill_md_non_description", ["--[a-z]"])


@query()
def spans_sampled(spark: SparkSession, d: str) -> DataFrame:
    rows = identifiers.layer_rows(_positives(spark, d).select("anchor_skill_id", "text", "stage"))
    s = spans.sampled(rows, "anchor_skill_id", "layer", "inner", 3)
    return s.select("anchor_skill_id", "stage", "layer", F.explode("spans").alias("s")).select("anchor_skill_id", "stage", "layer", "s.start_line", "s.end_line", "s.score")


@query()
def t3a_stub_rewrite(spark: SparkSession, d: str) -> DataFrame:
    return _row(spans.rewritten(_positives(spark, d)))


@query()
def parse_rewrites(spark: SparkSession, d: str) -> DataFrame:
    """Rewrites parsed from answers that the stand-in gives for whole instructions."""
    s = skills(spark, d, "skill_md_non_description").where("skill_md_non_description is not null").select("skill_id", F.col("skill_md_non_description").alias("t"))

    def run(batches):
        for b in batches:
            answers = spans.flip_rewriter([("I", [t]) for t in b["t"]])
            yield b.assign(rewrite=[spans.parse_rewrites(f"Sure, here:\n{a}", 1)[0] for a in answers])[["skill_id", "rewrite"]]

    return s.mapInPandas(run, "skill_id string, rewrite string")


# --- balance, pairs, scrub ------------------------------------------------------------------------------------------


def _view_sql(view: str) -> str:
    return f"{_V}, l as (select * from v where label in {balance.VIEWS[view]!r}), t as (select stage, split, min(n) target from (select stage, split, label, count(*) n from l group by all) group by all)"


@query(f"with {_view_sql('contrastive')} select * from t")
def balance_target(spark: SparkSession, d: str) -> DataFrame:
    return balance.targets(variant_table(spark, d), "contrastive")


def _balanced(view: str) -> Query:
    def f(spark: SparkSession, d: str) -> DataFrame:
        b = balance.balanced(variant_table(spark, d).where("stage is not null and split is not null"), view)
        return b.select("sample_id", "stage", "split", "balanced_label")

    f.__name__ = f"balanced_{view}"
    return query(f"with {_view_sql(view)}, r as (select *, row_number() over (partition by stage, split, label order by sha1(concat_ws('|', '42', label, sample_id)), sample_id) rn from l where stage is not null and split is not null) select sample_id, r.stage, r.split, label as balanced_label from r join t on t.stage = r.stage and t.split = r.split where rn <= target")(f)


balanced_cpt, balanced_contrastive = _balanced("cpt"), _balanced("contrastive")
_PAIRS = f"""{_V}, a as (select stage, split, anchor_skill_id, arg_max(text, sample_id) t from v where label = 'positive' and anchor_skill_id is not null and text is not null group by all),
 pr as (select v.*, a.t, case label when 't1' then 'positive' when 't2' then 'swapped' else 'corrupted' end kind from v join a using (stage, split, anchor_skill_id) where label in ('t1', 't2', 't3a', 't3b', 't3c'))"""


@query(f"with {_PAIRS} select sha1(encode(concat(anchor_skill_id, chr(0), stage, chr(0), split, chr(0), label, chr(0), coalesce(sample_id, ''), chr(0)))) as sample_id, anchor_skill_id, md5(t) as anchor_md5, md5(text) as pair_md5, kind as pair_kind, upper(label) as pair_subkind, cast(kind = 'positive' as bigint) as label, split from pr")
def hcl_pairs(spark: SparkSession, d: str) -> DataFrame:
    p = balance.pairs(variant_table(spark, d))
    return p.select("sample_id", "anchor_skill_id", F.md5("anchor_text").alias("anchor_md5"), F.md5("pair_text").alias("pair_md5"), "pair_kind", "pair_subkind", "label", "split")


@query(f"with {_PAIRS} select stage as anchor_stage, split, kind as pair_kind, upper(label) as pair_subkind, count(*) as n_rows from pr group by all")
def pair_kind_counts(spark: SparkSession, d: str) -> DataFrame:
    return balance.pair_counts(balance.pairs(variant_table(spark, d))).withColumnRenamed("rows", "n_rows")


@query(f"with {_V}, a as (select distinct stage, split, anchor_skill_id from v where label = 'positive' and anchor_skill_id is not null and text is not null) select v.stage, v.split, v.label, count(*) as n_rows from v left join a on a.stage = v.stage and a.split = v.split and a.anchor_skill_id = v.anchor_skill_id where v.label in ('t1', 't2', 't3a', 't3b', 't3c') and a.stage is null group by all")
def unpaired_counts(spark: SparkSession, d: str) -> DataFrame:
    return balance.unpaired(variant_table(spark, d)).withColumnRenamed("rows", "n_rows")


@query(f"with {_BAD} select r.skill_id, r.name from normalized_skill_records r where r.skill_id is null or not exists (select 1 from bad where bad.skill_id = r.skill_id)")
def scrub_skill_id(spark: SparkSession, d: str) -> DataFrame:
    return balance.scrub(load(spark, d, "normalized_skill_records"), bad_ids(spark, d), ["skill_id"]).select("skill_id", "name")


@query(f"with {_BAD}, t as (select sample_id, trim(anchor_skill_id, ' ') a, source_skill_ids[len(source_skill_ids)] b from variant_rows) select * from t where (a is null or a not in (select skill_id from bad)) and (b is null or b not in (select skill_id from bad))")
def scrub_two_columns(spark: SparkSession, d: str) -> DataFrame:
    t = load(spark, d, "variant_rows").select("sample_id", F.trim("anchor_skill_id").alias("a"), F.try_element_at("source_skill_ids", F.lit(-1)).alias("b"))
    return balance.scrub(t, bad_ids(spark, d), ["a", "b"])


@query(f"with {_BAD} select sample_id, anchor_skill_id from variant_rows where not exists (select 1 from bad where bad.skill_id = anchor_skill_id or list_contains(source_skill_ids, bad.skill_id))")
def scrub_array_donors(spark: SparkSession, d: str) -> DataFrame:
    return balance.scrub_donors(load(spark, d, "variant_rows"), bad_ids(spark, d)).select("sample_id", "anchor_skill_id")


@query(f"with {_BAD}, k as (select count(*) n from variant_rows where not exists (select 1 from bad where bad.skill_id = anchor_skill_id or list_contains(source_skill_ids, bad.skill_id))) select n as kept, (select count(*) from variant_rows) - n as dropped from k")
def scrub_report(spark: SparkSession, d: str) -> DataFrame:
    v = load(spark, d, "variant_rows")
    return balance.scrub_counts(v, balance.scrub_donors(v, bad_ids(spark, d)))


# --- canonical splits, resume, top n --------------------------------------------------------------------------------


@query(f"with {_BAD}, {q.SKILLS} select skill_id, name from skills where skill_id not in (select skill_id from bad)")
def train_anti_join(spark: SparkSession, d: str) -> DataFrame:
    return challenge.train_part(skills(spark, d, "name"), bad_ids(spark, d)).select("skill_id", "name")


@query(f"with {_BAD}, f as (select skill_id, min(ingested_at) first_at from normalized_skill_records where skill_id in (select skill_id from bad) group by 1) select skill_id, epoch_us(first_at) as first_us from f")
def challenge_semi_first(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "normalized_skill_records").select("skill_id", F.col("ingested_at").alias("first_at"))
    return challenge.challenge_part(c, bad_ids(spark, d), [F.col("first_at")]).select("skill_id", F.unix_micros("first_at").alias("first_us"))


@query(f"with {_V}, k as (select distinct anchor_skill_id, target_layer from v where label = 't3b'), t as (select distinct anchor_skill_id, target_layer from v where label = 't2') select t.* from t where not exists (select 1 from k where k.anchor_skill_id = t.anchor_skill_id and k.target_layer = t.target_layer)")
def resume_anti_join(spark: SparkSession, d: str) -> DataFrame:
    v = variant_table(spark, d)
    tasks = v.where("label = 't2'").select("anchor_skill_id", "target_layer").distinct()
    return readers.not_done(tasks, v.where("label = 't3b'"), ["anchor_skill_id", "target_layer"])


@query(f"with {q.SKILLS} select skill_id from skills order by sha1('t3a_eval|' || skill_id), skill_id limit 25")
def topn_hash_sample(spark: SparkSession, d: str) -> DataFrame:
    return balance.top_by_hash(skills(spark, d), 25, "t3a_eval", "skill_id")


# --- evaluation tables ----------------------------------------------------------------------------------------------


def _reviewed(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "reviewed").select("skill_id", "source", "final_safe", "final_align").distinct()


def _packages(spark: SparkSession, d: str) -> DataFrame:
    """Hold-out items as packages: the part before the rule is the description, the rest the body."""
    c = load(spark, d, "challenge_eval").select("skill_id", F.split(F.coalesce("skill_text", F.lit("")), "\n\n---\n\n", 2).alias("p"))
    files = F.array().cast("array<struct<path:string,content:string,size_bytes:bigint,truncated:boolean>>")
    return c.select("skill_id", F.lit("").alias("name"), F.col("p")[0].alias("description"), F.lit("").alias("section"), F.coalesce(F.get("p", F.lit(1)), F.lit("")).alias("body"), files.alias("package_files"))


_RULE = "chr(10) || chr(10) || '---' || chr(10) || chr(10)"
_PK = f"""rv as (select distinct skill_id, source, final_safe, final_align from reviewed), pk as (select skill_id, case when instr(t, {_RULE}) > 0 then substr(t, 1, instr(t, {_RULE}) - 1) else t end de, case when instr(t, {_RULE}) > 0 then substr(t, instr(t, {_RULE}) + 7) else '' end bo from (select skill_id, coalesce(skill_text, '') t from challenge_eval)),
 gd as (select skill_id, coalesce(nullif(lower(source), ''), 'unknown') source, case when upper(trim(final_safe, ' ')) in ('SAFE', 'SUSPICIOUS', 'MALICIOUS') then upper(trim(final_safe, ' ')) end gs, case when upper(trim(final_align, ' ')) in ('ALIGNED', 'MISALIGNED') then upper(trim(final_align, ' ')) end ga from rv)"""


@query(f"with {_PK} select g.skill_id, md5(substr({q.strip(f'{q.strip(chr(100) + chr(101))} || {_RULE} || {q.strip(chr(98) + chr(111))}')}, 1, 16000)) as text_md5, gs as overall_class, ga as alignment_class, source, 'test' as split from gd g join pk using (skill_id)")
def challenge_eval_rows(spark: SparkSession, d: str) -> DataFrame:
    e = challenge.eval_rows(_reviewed(spark, d), _packages(spark, d))
    return e.select("skill_id", F.md5("skill_text").alias("text_md5"), "overall_class", "alignment_class", "source", "split")


_EV = f"""substr({q.rstrip(f"'# Skill Name' || chr(10) || skill_id || chr(10) || chr(10) || '# Evidence' || chr(10) || '---' || chr(10) || 'name: ' || skill_id || chr(10) || 'description: ' || de || chr(10) || '---' || chr(10) || chr(10) || case when bo <> '' then {q.strip('bo')} || chr(10) || chr(10) else '' end || '# Files' || chr(10)")}, 1, 20000)"""


@query(f"with {_PK} select skill_id, md5({_EV}) as evidence_md5 from pk")
def render_evidence(spark: SparkSession, d: str) -> DataFrame:
    p = _packages(spark, d)
    return p.select("skill_id", F.md5(challenge.evidence(F.col("skill_id"), F.col("description"), F.col("section"), F.col("body"), F.col("package_files"))).alias("evidence_md5"))


def _classifier(spark: SparkSession, d: str) -> DataFrame:
    return challenge.classifier_rows(_reviewed(spark, d), _packages(spark, d))


_CL = f"""{_PK}, cl as (select g.skill_id, source, gs, ga, cast(ga = 'ALIGNED' as bigint) l, de, {_EV.replace('skill_id', 'g.skill_id')} e from gd g join pk on pk.skill_id = g.skill_id where ga is not null and bo <> '')"""


@query(f"with {_CL} select sha1(encode(skill_id || chr(0) || 'self' || chr(0) || l || chr(0))) as example_id, skill_id, l as label, case when l = 1 then 'yes' else 'no' end as target_text, md5('Skill name: ' || skill_id || chr(10) || chr(10) || 'Evidence:' || chr(10) || e || chr(10) || chr(10) || 'Candidate description:' || chr(10) || de || chr(10) || chr(10) || 'Does the candidate description match the skill? Answer yes or no.') as input_md5, lower(ga) as misalignment_response, gs as final_safe, source from cl")
def sft_classifier_rows(spark: SparkSession, d: str) -> DataFrame:
    return _classifier(spark, d).select("example_id", "skill_id", "label", "target_text", F.md5("input_text").alias("input_md5"), "misalignment_response", "final_safe", "source")


@query(f"with {_CL} select skill_id, md5('Judge:' || chr(10) || e || chr(10) || 'Answer:') as user_md5, lower(ga) as answer, l as label from cl")
def chat_messages(spark: SparkSession, d: str) -> DataFrame:
    c = challenge.chat_rows(_classifier(spark, d), "You are careful.", "Judge:\n{skill_text}\nAnswer:")
    return c.select("metadata.skill_id", F.md5(F.col("messages")[1]["content"]).alias("user_md5"), F.col("messages")[2]["content"].alias("answer"), "metadata.label")


@query(f"with {_CL} select skill_id, md5(e) as text_md5, case when l = 1 then 'ALIGNED' else 'MISALIGNED' end as alignment_class from cl")
def add_misalignment_columns(spark: SparkSession, d: str) -> DataFrame:
    return challenge.add_columns(_classifier(spark, d).drop("skill_text", "alignment_class")).select("skill_id", F.md5("skill_text").alias("text_md5"), "alignment_class")


@query(f"""with {_PK}, o as (select case when ga is null then 'no_label' when pk.skill_id is null then 'missing_package' when bo = '' then 'no_text' end reason from gd g left join pk on pk.skill_id = g.skill_id) select reason, count(*) as n_rows from o group by 1""")
def sft_skip_reasons(spark: SparkSession, d: str) -> DataFrame:
    return challenge.outcome(_reviewed(spark, d), _packages(spark, d)).groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))


# The same on skills with files, labelled by their verdicts.

_FULL_PK = f"""{_INDEX}, {q.SKILLS}, fl as (select skill_id, string_agg('## ' || coalesce(f.path, '') || chr(10) || substr(f.content, 1, 12000) || chr(10), chr(10) order by i) b from (select skill_id, unnest(package_files) f, unnest(range(1, len(package_files) + 1)) i from skills) where coalesce(f.content, '') <> '' group by 1),
 fk as (select s.skill_id, coalesce(name, '') nm, coalesce(description_text, '') de, coalesce(skill_md_description, '') se, coalesce(skill_md_non_description, '') bo, coalesce(b, '') fb from skills s left join fl on fl.skill_id = s.skill_id)"""
_FULL_EV = lambda n: f"""substr({q.rstrip(f"'# Skill Name' || chr(10) || {n} || chr(10) || chr(10) || '# Evidence' || chr(10) || '---' || chr(10) || 'name: ' || {n} || chr(10) || 'description: ' || de || chr(10) || '---' || chr(10) || chr(10) || case when se <> '' then '## Description' || chr(10) || se || chr(10) || chr(10) else '' end || case when bo <> '' then {q.strip('bo')} || chr(10) || chr(10) else '' end || '# Files' || chr(10) || fb")}, 1, 20000)"""


def _full(spark: SparkSession, d: str) -> DataFrame:
    s = skills(spark, d, "name", "description_text", "skill_md_description", "skill_md_non_description", "package_files")
    return s.select("skill_id", "name", F.col("description_text").alias("description"), F.col("skill_md_description").alias("section"), F.col("skill_md_non_description").alias("body"), "package_files")


def _judged_skills(spark: SparkSession, d: str) -> DataFrame:
    return index(spark, d).select("skill_id", F.lit("Verdict").alias("source"), F.col("overall_class").alias("final_safe"), F.col("alignment_class").alias("final_align"))


@query(f"with {_FULL_PK} select skill_id, md5({_FULL_EV('nm')}) as evidence_md5, cast(length({_FULL_EV('nm')}) as int) as chars from fk")
def render_evidence_files(spark: SparkSession, d: str) -> DataFrame:
    e = _full(spark, d).select("skill_id", challenge.evidence(*map(F.col, ("name", "description", "section", "body", "package_files"))).alias("e"))
    return e.select("skill_id", F.md5("e").alias("evidence_md5"), F.length("e").alias("chars"))


_FULL_CL = f"""{_FULL_PK}, cl as (select skill_id, cast(ac = 'ALIGNED' as bigint) l, case when oc in ('SAFE', 'SUSPICIOUS', 'MALICIOUS') then oc end gs, n2, case when de <> '' then de else se end ca, {_FULL_EV('n2')} e from (select fk.*, oc, ac, case when nm <> '' then nm else fk.skill_id end n2 from fk join ix using (skill_id) where ac in ('ALIGNED', 'MISALIGNED') and bo <> ''))"""


@query(f"with {_FULL_CL} select sha1(encode(skill_id || chr(0) || 'self' || chr(0) || l || chr(0))) as example_id, skill_id, l as label, md5('Skill name: ' || n2 || chr(10) || chr(10) || 'Evidence:' || chr(10) || e || chr(10) || chr(10) || 'Candidate description:' || chr(10) || ca || chr(10) || chr(10) || 'Does the candidate description match the skill? Answer yes or no.') as input_md5, gs as final_safe, 'verdict' as source from cl")
def sft_rows_with_files(spark: SparkSession, d: str) -> DataFrame:
    return challenge.classifier_rows(_judged_skills(spark, d), _full(spark, d)).select("example_id", "skill_id", "label", F.md5("input_text").alias("input_md5"), "final_safe", "source")


@query(f"with {_FULL_CL} select skill_id, md5('Judge:' || chr(10) || e || chr(10) || 'Answer:') as user_md5, l as label from cl")
def chat_messages_with_files(spark: SparkSession, d: str) -> DataFrame:
    c = challenge.chat_rows(challenge.classifier_rows(_judged_skills(spark, d), _full(spark, d)), "You are careful.", "Judge:\n{skill_text}\nAnswer:")
    return c.select("metadata.skill_id", F.md5(F.col("messages")[1]["content"]).alias("user_md5"), "metadata.label")


@query(f"""with {_FULL_PK}, c as (select skill_id, {q.clean('nm')} n, {q.clean('de')} d, {q.clean('bo')} b from fk)
select skill_id, md5({q.clip('d', 200)}) as description_md5, md5({q.clip('b', 200)}) as markdown_md5, cast(length({q.clip('b', 200)}) as bigint) as markdown_len, md5(n) as name_md5 from c""")
def stage_rows(spark: SparkSession, d: str) -> DataFrame:
    s = skills(spark, d, "name", "description_text", "skill_md_non_description", "package_files_text", "text").withColumnRenamed("text", "full_text")
    r = samples.stage_row(s, 200)
    return r.select("skill_id", F.md5("stage_description").alias("description_md5"), F.md5("stage_markdown").alias("markdown_md5"), F.col("stage_markdown_len").alias("markdown_len"), F.md5("stage_name").alias("name_md5"))


@query(f"""with {_FULL_PK}, c as (select skill_id, {q.clean('nm')} n, {q.clean('de')} d, {q.clean('bo')} b from fk)
select skill_id, md5({q.strip(f"'Skill name: ' || n || chr(10) || chr(10) || 'Evidence:' || chr(10) || {q.clip('b', 500)} || chr(10) || chr(10) || 'Candidate description:' || chr(10) || d || chr(10) || chr(10) || 'Does the candidate description match the skill? Answer yes or no.'")}) as prompt_md5 from c""")
def match_prompts(spark: SparkSession, d: str) -> DataFrame:
    p = _full(spark, d).select("skill_id", challenge.match_prompt(F.col("name"), F.col("body"), F.col("description"), 500).alias("p"))
    return p.select("skill_id", F.md5("p.prompt").alias("prompt_md5"))


_RV = "r as (select distinct * from reviewed)"
_GOLD = lambda c, v: f"case when upper(trim({c}, ' ')) in {v!r} then upper(trim({c}, ' ')) end"


@query(f"with {_RV} select r.skill_id, {_GOLD('final_safe', challenge.SAFE)} as gold_safe, {_GOLD('final_align', challenge.ALIGN)} as gold_align, hsb_tier, bench_classification, r.static_rule_class, coalesce(nullif(lower(r.source), ''), 'unknown') as source from r join challenge_eval using (skill_id)")
def labels_and_scans(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "challenge_eval").select("skill_id")
    j = challenge.with_labels(c, load(spark, d, "reviewed").distinct())
    return j.select("skill_id", F.col("gold.final_safe").alias("gold_safe"), F.col("gold.final_align").alias("gold_align"), "scan.hsb_tier", "scan.bench_classification", "scan.static_rule_class", "source")


@query("select skill_id, source from (select distinct skill_id, source from reviewed) order by skill_id nulls first, source nulls first limit 40")
def reviewed_first(spark: SparkSession, d: str) -> DataFrame:
    r = load(spark, d, "reviewed").select("skill_id", "source").distinct()
    return challenge.first_rows(r, 40, [F.col("skill_id").asc_nulls_first(), F.col("source").asc_nulls_first()])


@query(f"""with {_BAD}, {q.SKILLS}, w as (select skill_id, row_number() over (order by skill_id) - 1 ord from (select skill_id from bad union select skill_id from challenge_eval)),
 f as (select skill_id, 'found' origin from skills where skill_id in (select skill_id from w)), l as (select skill_id, 'local' origin from challenge_eval where skill_id not in (select skill_id from f))
select w.ord, w.skill_id, origin from (select * from f union all select * from l) join w using (skill_id)""")
def challenge_fill_missing(spark: SparkSession, d: str) -> DataFrame:
    local = load(spark, d, "challenge_eval").select("skill_id", F.lit("local").alias("origin"))
    ids = bad_ids(spark, d).unionByName(local.select("skill_id")).distinct().withColumn("_all", F.lit(0))
    wanted = positions.dense_positions(ids, ["_all"], [F.col("skill_id")], "ord")
    found = challenge.challenge_part(load(spark, d, "normalized_skill_records").select("skill_id", "ingested_at"), wanted, [F.col("ingested_at")])
    return challenge.fill_missing(found.select("skill_id", F.lit("found").alias("origin")), local, wanted).select("ord", "skill_id", "origin")


@query(f"with {_BAD}, l as (select sample_id, trim(anchor_skill_id, ' ') a, source_skill_ids[1] b from variant_rows where substr(sha1(sample_id), 1, 1) <> '0') select sample_id from l where (a is null or a not in (select skill_id from bad)) and (b is null or b not in (select skill_id from bad))")
def scrub_json_lines(spark: SparkSession, d: str) -> DataFrame:
    """Rows as JSON lines, a sixteenth of them malformed; these are dropped."""
    v = load(spark, d, "variant_rows")
    record = F.to_json(F.struct("sample_id", F.struct(F.trim("anchor_skill_id").alias("skill_id"), F.try_element_at("source_skill_ids", F.lit(1)).alias("candidate_skill_id")).alias("metadata")))
    lines = v.select(F.when(F.substring(F.sha1("sample_id"), 1, 1) == "0", F.concat(F.lit("{"), record)).otherwise(record).alias("value"))
    return balance.scrub_json_lines(lines, bad_ids(spark, d)).select(F.get_json_object("value", "$.sample_id").alias("sample_id"))


@query()
def frontmatter_parse(spark: SparkSession, d: str) -> DataFrame:
    f = challenge.frontmatter(load(spark, d, "documents").where("text is not null").select("doc_id", F.col("text").alias("skill_md")))
    return f.select("doc_id", "front.name", "front.description", F.length("body").alias("body_chars"))


_HEAD = f"(?im)^(#+){q.WS}+(description){q.WS}*$"
_NEXT = rf"(?m)^#+{q.WS}+[^\t-\r\x1c-\x20\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]"


@query(f"""with t as (select doc_id, text, regexp_extract(text, '{_HEAD}', 0) mark, length(string_split_regex(text, '{_HEAD}')[1]) p from documents where text is not null),
 a as (select *, substr(text, p + length(mark) + 1) aft from t), b as (select *, case when mark <> '' and regexp_matches(aft, '{_NEXT}') then length(string_split_regex(aft, '{_NEXT}')[1]) end e from a)
select doc_id, mark <> '' as found, md5(case when mark <> '' then {q.strip('substr(aft, 1, coalesce(e, length(aft)))')} else '' end) as content_md5,
 md5({q.strip("regexp_replace(case when mark <> '' then substr(text, 1, p) || case when e is not null then substr(aft, e + 1) else '' end else text end, '\\n{3,}', chr(10)||chr(10), 'g')")}) as rest_md5 from b""")
def description_sections(spark: SparkSession, d: str) -> DataFrame:
    s = load(spark, d, "documents").where("text is not null").select("doc_id", text.description_section(F.col("text")).alias("s"))
    return s.select("doc_id", "s.found", F.md5("s.content").alias("content_md5"), F.md5("s.rest").alias("rest_md5"))


# --- stats --------------------------------------------------------------------------------------------------------------


@query("select lower(trim(label, ' ')) as value, count(*) as n_rows from variant_rows group by 1")
def label_distribution(spark: SparkSession, d: str) -> DataFrame:
    v = load(spark, d, "variant_rows").withColumn("label", F.lower(F.trim("label")))
    return stats.histogram(v, "label").withColumnRenamed("rows", "n_rows")


@query(f"with {_V} select output_version, stage, split, cast(grouping(output_version, stage, split) as bigint) as level, count(*) as n_rows from v group by rollup (output_version, stage, split)")
def family_rollup(spark: SparkSession, d: str) -> DataFrame:
    return stats.family_totals(variant_table(spark, d)).withColumnRenamed("rows", "n_rows")


@query("select strftime(ts, '%Y-%m-%d') as day, event_type, count(*) as n_rows from events group by all")
def events_daily(spark: SparkSession, d: str) -> DataFrame:
    return incremental.late_counts(load(spark, d, "events"), "ts").select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", F.col("rows").alias("n_rows"))
