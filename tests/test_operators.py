import json
import os
import re

import pytest
from pyspark.sql import functions as F

from millrace.operators import balance, challenge, identifiers, normalize, positions, samples, spans, variants, verdicts
from millrace.sources import files, readers, writers

FILE = "struct<path:string,content:string,size_bytes:bigint,truncated:boolean>"


def test_verdict_index_and_policy(spark):
    rows = [(" a ", "safe", "aligned", 1), ("a", "MALICIOUS ", None, 2), ("b", "SAFE", "misaligned", 1), ("", "SAFE", "ALIGNED", 1), (None, "SAFE", "ALIGNED", 1), ("e", "ERROR", "ERROR", 1)]
    v = spark.createDataFrame(rows, "skill_id string, overall_class string, alignment_class string, at int")
    index = readers.verdict_index(v, [F.col("at")])
    assert {(r.skill_id, r.overall_class, r.alignment_class) for r in index.collect()} == {("a", "MALICIOUS", ""), ("b", "SAFE", "MISALIGNED"), ("e", "ERROR", "ERROR")}
    records = spark.createDataFrame([("a",), (" a ",), ("b",), ("e",), ("e",), ("z",)], "skill_id string")
    r = verdicts.report(verdicts.judge(records, index, verdicts.Policy())).first().asDict()
    assert r == {"kept": 2, "excluded_by_overall": 1, "excluded_by_alignment": 1, "excluded_by_either": 2, "unscanned_kept": 2, "unscanned_dropped": 0}
    strict = verdicts.Policy.of({"unscanned_action": "DROP", "exclude_alignment_classes": []})
    assert {x.skill_id for x in verdicts.judge(records, index, strict).where("keep").collect()} == {"b", "e"}
    assert verdicts.Policy.of({"unscanned_action": "?"}).keep_unscanned


def test_packing_files(spark):
    files = [("", "", 1, False), (None, None, None, None), ("a", "x" * 30, 5, False), ("b", "y" * 30, 5, True), ("c", "z", 5, None)]
    df = spark.createDataFrame([(files,), (None,), ([],)], f"f array<{FILE}>").withColumn("f", normalize.clean_files(F.col("f"), 20))
    got = df.select("f", normalize.pack_files(F.col("f"), 60).alias("p"), normalize.pack_files(F.col("f"), 0).alias("none")).collect()
    # The third block has 4 characters left, less than the mark, which is then all that stays of it.
    assert got[0].p.text == "### a\nxxxxxxx\n\n[TRUNCATED]\n\n### b\nyyyyyyy\n\n[TRUNCATED]\n\n\n\n[TRUNCATED]" and got[0].p.n_clipped == 1
    assert got[0].none.text == "" and got[1].p.text == "" and got[2].f == []
    assert [f.truncated for f in got[0].f] == [False, False, True, True, False]


def test_sections_and_samples(spark):
    rows = [("s1", "n", "d", "do it", [("p", "content", 7, False)], 10, 7), ("s2", "", "", "", [], 0, 0), ("s3", None, None, "x" * 50, None, 50, 0), ("big", "n", "d", "i", [], 10**9, 0)]
    df = spark.createDataFrame(rows, f"skill_id string, name string, description_text string, skill_md_non_description string, package_files array<{FILE}>, text_char_count bigint, package_files_total_bytes bigint")
    s = samples.phase1(df).collect()
    assert {(r.skill_id, r.stage) for r in s} == {("s1", "stage1"), ("s1", "stage2"), ("s3", "stage1")}
    assert next(r.text for r in s if r.stage == "stage2") == "<METADATA>\nname: n\ndescription: d\n</METADATA>\n<INSTRUCTION>\ndo it\n</INSTRUCTION>\n<RESOURCE>\n### p\ncontent\n</RESOURCE>"
    tight = samples.emit_counts(df, samples.Budgets(stage1_tokens=20, stage2_tokens=20)).first().asDict()
    assert tight == {"any": 2, "stage1": 2, "stage2": 0, "none": 1, "oversize": 1}
    many = spark.createDataFrame([([("a", "1" * 40, 1, False), ("b", "2" * 40, 1, False), ("c", "3", 1, False)],)], f"f array<{FILE}>")
    r = many.select(samples.resource_section(F.col("f"), 0, 70).alias("r")).first().r
    assert (r.included, r.dropped, r.truncated) == (2, 1, 1)


@pytest.mark.parametrize("parts", [1, 7])
def test_positions_do_not_depend_on_partitions(spark, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    rows = [("g" if i % 3 else None, (i * 7919) % 1000) for i in range(300)]
    got = positions.dense_positions(spark.createDataFrame(rows, "g string, v int").repartition(parts), ["g"], [F.col("v")]).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    for g in ("g", None):
        want = {v: i for i, v in enumerate(sorted(v for k, v in rows if k == g))}
        assert {r.v: r.pos for r in got if r.g == g} == want


def _samples(spark, n, stage="stage2"):
    rows = [(f"s{i:03d}", stage, "cpt", "train", f"text {i}", f"<METADATA>\nm{i}\n</METADATA>", "<INSTRUCTION>\n" + f"line {i} " * 60 + "\n</INSTRUCTION>", "<RESOURCE>\n" + f"row {i} " * (60 if i % 2 else 5) + "\n</RESOURCE>") for i in range(n)]
    return spark.createDataFrame(rows, "skill_id string, stage string, pool string, split string, text string, metadata_text string, instruction_text string, resource_text string")


@pytest.mark.parametrize("n", [1, 2, 3, 6])
def test_donors_follow_the_walk(spark, n):
    import hashlib

    s = _samples(spark, n)
    got = {(r.skill_id, r.pattern, r.k): r.donors for r in variants.donors(variants.donor_requests(s), variants.donor_pools(s), 20260601).collect()}
    ids = [f"s{i:03d}" for i in range(n)]
    for sid in ids:
        for p, m in variants.T2["stage2"].items():
            for k in range(2):
                seed = int(hashlib.sha1(f"20260601|{sid}|{p}|{k}".encode()).hexdigest()[:16], 16)
                step, at, picked, need = (seed >> 32) | 1, seed % n, [], 2 if "C" in m.values() else 1
                step = 1 if step % n == 0 else step
                for _ in range(n + 1):
                    d = ids[at % n]
                    if d != sid and d not in picked and len(picked) < need:
                        picked.append(d)
                    at += step
                assert got.get((sid, p, k)) == (picked if len(picked) == need else None)


def test_variants(spark):
    s = _samples(spark, 6)
    v = variants.variants(s).collect()
    assert {r.label for r in v} == {"positive", "T1", "T2", "T3b"}
    one = {r.sub_strategy: r.text for r in v if r.label == "T1" and r.anchor_skill_id == "s001"}
    assert len(one) == 5 and one["order=R>I>M"].startswith("<RESOURCE>")
    texts = {r.anchor_skill_id: r for r in s.select(F.col("skill_id").alias("anchor_skill_id"), "instruction_text", "resource_text", "metadata_text").collect()}
    for r in v:
        assert r.anchor_skill_id not in r.source_skill_ids[1:]
        if r.label == "T3b" and r.target_layer == "I":
            a = texts[r.anchor_skill_id]
            assert len(r.text) == len("\n".join([a.metadata_text, a.instruction_text, a.resource_text]))
    keys = [(r.stage, r.sample_id, r.label) for r in v]
    assert len(set(keys)) == len(keys)
    assert variants.permuted(s, variants.Config(max_tokens={"stage1": 1, "stage2": 1})).count() == 0


def _plain_places(t):
    def fake(name, kind):
        import hashlib

        return name + identifiers.ENDINGS[hashlib.sha1(f"{kind}|{name}".encode()).digest()[0] % 7]

    pkg = lambda n: bool(re.fullmatch(r"[a-z][a-z0-9_-]{2,}", n)) and n not in identifiers.STANDARD
    out = []

    def add(m, table, key, kind, package, name, make):
        new, k = (table[key], kind) if key in table else (fake(name, kind), f"{kind}_generic") if pkg(package) else (None, None)
        if k:
            out.append((m.start(), m.end(), make(new), k))

    bare = lambda k: k.lstrip("@").split("/")[-1] if k.startswith("@") else k
    for m in re.finditer(identifiers.IMPORT, t, re.M):
        top = m[3].split(".")[0].lower()
        add(m, identifiers.PIP, top, "py_import", top, top, lambda n, m=m, top=top: f"{m[1]}{m[2]} {n}{m[3][len(top):]}")
    for m in re.finditer(identifiers.PIN, t, re.M):
        add(m, identifiers.PIP, m[1].lower(), "pip_pin", m[1].lower(), m[1].lower(), lambda n, m=m: n + m[2] + m[3])
    for m in re.finditer(identifiers.DEPENDENCY, t):
        add(m, identifiers.NPM, m[1].lower(), "npm_dep", bare(m[1].lower()), m[1], lambda n, m=m: m[0].replace(f'"{m[1]}"', f'"{n}"', 1))
    for m in re.finditer(identifiers.REQUIRE, t):
        add(m, identifiers.NPM, m[1].lower(), "js_require", bare(m[1].lower()), m[1], lambda n, m=m: m[0].replace(m[1], n, 1))
    for m in re.finditer(identifiers.NPM_COMMAND, t):
        add(m, identifiers.NPM, m[3].lower(), "npm_cmd", bare(m[3].lower()), m[3], lambda n, m=m: f"{m[1]} {m[2]} {n}")
    for m in re.finditer(identifiers.PIP_COMMAND, t):
        add(m, identifiers.PIP, m[1].lower(), "pip_cmd", m[1].lower(), m[1].lower(), lambda n: f"pip install {n}")
    for m in re.finditer(identifiers.FLAG, t):
        known = m[0] in identifiers.FLAGS
        out.append((m.start(), m.end(), identifiers.FLAGS.get(m[0]) or fake(m[0], "cli_flag"), "cli_flag" if known else "cli_flag_generic"))
    for m in re.finditer(identifiers.VARIABLE, t):
        if m[1] in identifiers.VARIABLES:
            out.append((m.start(), m.end(), identifiers.VARIABLES[m[1]], "env_var"))
    kept, end = [], -1
    for h in sorted(out):
        if h[0] >= end:
            kept.append(h)
            end = h[1]
    return kept


IDENTIFIERS = [
    "import pandas as pd\n  from os import path\n\nimport torch.nn as nn", "pip install numpy && pip install left-pad", "requests>=2.31\nPyYAML == 6.0\nsys==1", '"lodash": "^4.17.0", "@nx/react": "1", "key": "value"', "const x = require('axios'); require(\"./a/b\"); require('@types/node')",
    "npm install react --force-with-lease\nyarn add @scope/thing --save-dev", "export OPENAI_API_KEY=x; UNKNOWN_NAME=1", "", "é --größe import ñandú\nfrom módulo import x", "--a --bb", "import   requests\nrun --dry-run pip install --no-cache",
]


def test_identifier_places_against_plain_code(spark):
    df = spark.createDataFrame(list(enumerate(IDENTIFIERS)), "i int, t string").withColumn("h", identifiers.find_places(F.col("t")))
    chosen = df.withColumn("c", identifiers.choose(F.col("h"), 2, F.col("t"))).withColumn("all", identifiers.splice(F.col("t"), F.col("h"))).withColumn("two", identifiers.splice(F.col("t"), F.col("c")))
    for r in chosen.collect():
        want = _plain_places(r.t)
        assert [tuple(h) for h in r.h] == want, r.t
        out, at = "", 0
        for a, b, new, _ in want:
            out, at = out + r.t[at:a] + new, b
        assert r.all == out + r.t[at:]
        assert len(r.c) == min(2, len(want)) and {tuple(h) for h in r.c} <= set(want)


def test_line_scores_against_plain_code(spark):
    lines = ["if x == 3: return f(a, 'b')", "", "  ", "import os", "pip install x --flag", "https://a.b/c?d=e config/app.yaml", "élan = True", "MAX_SIZE"]
    df = spark.createDataFrame([(1, "\n".join(lines)), (2, None), (3, "a")], "i int, t string")
    for ps in (spans.BEHAVIOUR, spans.REFERENCES):
        got = {(r.i, r.line_no): r.score for r in spans.line_scores(df, "i", "t", ps).collect()}
        assert [got[1, k] for k in range(len(lines))] == [sum(len(re.findall(p, x)) for p in ps) if x.strip() else 0 for x in lines]
        assert (2, 0) not in got and (3, 0) in got
    w = {(r.i, r.start): (r.stop, r.score) for r in spans.span_windows(df, "i", "t", ["--"], 4).collect()}
    assert w[3, 0] == (1, 1.0) and len([k for k in w if k[0] == 1]) == 5


def test_spans_and_rewrites():
    t = "\n".join(f"step {i} if x" for i in range(40))
    ps = [re.compile(p) for p in spans.BEHAVIOUR]
    got = spans.sample(t, ps, 3, ("tag", "id"))
    assert got == spans.sample(t, ps, 3, ("tag", "id")) and len(got) == 3
    assert all(a[1] <= b[0] for a, b in zip(got, got[1:]))
    assert spans.sample("", ps, 3, ()) == [] and spans.sample("a\nb", ps, 3, ())[0][:2] == (0, 2)
    where = [(a, b) for a, b, _, _ in got]
    assert spans.splice(t, where, ["", " ", ""]) == t
    assert spans.splice("a\nb\nc", [(1, 2)], ["X\n"]) == "a\nX\nc"
    for bad in ([(0, 2), (1, 3)], [(0, 1)]):
        with pytest.raises(ValueError):
            spans.splice("a\nb\nc", bad, ["x", "y"])
    assert spans.parse_rewrites("Sure!\n===REWRITE===\n```py\none\n```\n=== 2 REWRITE ===Here is it\ntwo", 3) == ["one", "two", ""]
    assert spans.parse_rewrites("", 2) == ["", ""] and spans.parse_rewrites("===REWRITE===\na\n===REWRITE===\nb", 1) == ["a"]


def _rows(spark):
    rows = [(f"p{i}", f"k{i}", "Positive ", f"P{i}", ["x"]) for i in range(5)] + [(f"t{i}", f"k{i % 7}", "t1", f"T{i}", [f"k{i}"]) for i in range(9)] + [("u0", "k1", "t2", "U", None), ("u1", None, "t3c", "U", ["k0", "k3"])]
    return spark.createDataFrame([(*r, "stage1", "train", "", "s", "cpt") for r in rows], "sample_id string, anchor_skill_id string, label string, text string, source_skill_ids array<string>, stage string, split string, target_layer string, sub_strategy string, pool string")


def test_balance_and_pairs(spark):
    v = _rows(spark)
    b = balance.balanced(v, "cpt").groupBy("balanced_label").count().collect()
    assert {r.balanced_label: r["count"] for r in b} == {"positive": 5, "t1": 5}
    assert balance.balanced(v, "cpt", cap=100).count() == 14  # never more than there are
    again = balance.balanced(v.repartition(5), "cpt").select("sample_id").collect()
    assert sorted(again) == sorted(balance.balanced(v, "cpt").select("sample_id").collect())
    p = balance.pairs(v).collect()
    assert all(r.anchor_text == "P" + r.anchor_skill_id[1:] for r in p) and len(p) == 8
    assert balance.unpaired(v).agg(F.sum("rows")).first()[0] == 3


def test_scrub_keeps_nulls_and_reads_printed_lists(spark):
    v, bad = _rows(spark), spark.createDataFrame([("k0",), ("k3",)], "skill_id string")
    assert {r.anchor_skill_id for r in balance.scrub(v, bad, ["anchor_skill_id", "missing"]).collect()} == {"k1", "k2", "k4", "k5", "k6", None}
    left = balance.scrub_donors(v, bad).collect()
    assert all(r.anchor_skill_id not in ("k0", "k3") and not {"k0", "k3"} & set(r.source_skill_ids or []) for r in left)
    assert balance.scrub_donors(v, bad.where("false")).count() == v.count()
    printed = v.withColumn("source_skill_ids", F.lit("['k9', 'k3']"))
    assert balance.scrub_donors(printed, bad).count() == 0
    lines = spark.createDataFrame([('{"metadata": {"skill_id": "k0"}}',), ('{"metadata": {"skill_id": "k8", "candidate_skill_id": "k3"}}',), ("broken {",), ('{"metadata": {}}',)], "value string")
    assert [r.value for r in balance.scrub_json_lines(lines, bad).collect()] == ['{"metadata": {}}']


def test_frontmatter_and_evaluation_rows(spark):
    assert challenge.parse_frontmatter("---\nname: a\ndescription: 'b: c'\n---\nbody") == ("a", "b: c", "body")
    assert challenge.parse_frontmatter("no fence") == ("", "", "no fence")
    assert challenge.parse_frontmatter("---\n: : [\n---\nx")[:2] == ("", "") and challenge.parse_frontmatter("---\n- 1\n---\nx") == ("", "", "x") and challenge.parse_frontmatter(None) == ("", "", "")
    reviewed = spark.createDataFrame([("a", "s", "safe", "aligned "), ("b", "s", "", "MISALIGNED"), ("c", "s", None, "?"), ("z", "s", "SAFE", "ALIGNED")], "skill_id string, source string, final_safe string, final_align string")
    files = [("f", "code", 4, False), ("g", "", 0, False), ("h", None, 0, None)]
    skills = spark.createDataFrame([("a", "A", "desc", "", "body", files), ("b", "", "", "sec", " body ", None), ("c", "", "", "", "x", [])], f"skill_id string, name string, description string, section string, body string, package_files array<{FILE}>")
    assert {r.skill_id: r.reason for r in challenge.outcome(reviewed, skills).collect()} == {"a": None, "b": None, "c": "no_label", "z": "missing_package"}
    rows = {r.skill_id: r for r in challenge.classifier_rows(reviewed, skills).collect()}
    assert rows["a"].evidence_text == "# Skill Name\nA\n\n# Evidence\n---\nname: A\ndescription: desc\n---\n\nbody\n\n# Files\n## f\ncode"
    assert (rows["b"].label, rows["b"].candidate_description, rows["b"].final_safe) == (0, "sec", None)
    assert challenge.eval_rows(reviewed, skills).where("skill_id = 'a'").first().skill_text == "desc\n\n---\n\nbody"


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text('{"skill_id": "a", "x": 1}\n\n{broken\n{"x": 2}\n')
    t = readers.json_lines_tolerant(spark, str(tmp_path / "in.jsonl"), "skill_id string, x int").collect()
    assert [(r.value, r.bad) for r in t] == [('{"skill_id": "a", "x": 1}', False), ("{broken", True), ('{"x": 2}', True)]
    with pytest.raises(Exception):
        readers.json_lines(spark, str(tmp_path / "in.jsonl"), "skill_id string, x int").collect()
    (tmp_path / "v.csv").write_text('id,note\n1,"two\nlines"\n')
    assert readers.csv_rows(spark, str(tmp_path / "v.csv")).first().note == "two\nlines"
    df = spark.createDataFrame([("b", 1, None), ("a", 2, "é")], "k string, n int, z string")
    writers.write_version(df, str(tmp_path / "out"), ["k"])
    with pytest.raises(Exception):
        writers.write_version(df, str(tmp_path / "out"))
    writers.write_json_lines(df, str(tmp_path / "json"))
    assert {r.value for r in spark.read.text(str(tmp_path / "json")).collect()} == {'{"k":"b","n":1,"z":null}', '{"k":"a","n":2,"z":"é"}'}
    m = writers.write_manifest(spark, str(tmp_path / "out"), "d", "v1", {"rows": 2}, now="2026-01-01")
    parts = {str(p.relative_to(tmp_path / "out")): writers.file_sha256(str(p)) for p in (tmp_path / "out").rglob("*.parquet")}
    assert {k: f["sha256"] for k, f in m["files"].items()} == parts and len(parts) == 2
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2 and json.loads((tmp_path / "out/_stats.json").read_text()) == {"rows": 2}
    reg = str(tmp_path / "reg.json")
    writers.register(spark, reg, "d", {"version": "v1", "created_at": "2"})
    writers.register(spark, reg, "d", {"version": "v0", "created_at": "1"})
    assert [r["version"] for r in writers.register(spark, reg, "d", {"version": "v1", "created_at": "3"})] == ["v0", "v1"]
    assert files.exists(spark, "file://" + reg) and not files.exists(spark, "file://" + reg + "x")
    (tmp_path / "stale.jsonl").write_text("x")
    assert files.remove_stale(spark, str(tmp_path), ["stale.jsonl", "none"]) == ["stale.jsonl"] and not (tmp_path / "stale.jsonl").exists()
    writers.write_csv(df, str(tmp_path / "csv"))
    assert {r.z for r in readers.csv_rows(spark, str(tmp_path / "csv")).collect()} == {None, "é"}
    assert readers.parquet_columns(spark, str(tmp_path / "none"), ["a"]) is None and readers.done_keys(spark, str(tmp_path / "none")).count() == 0


def test_directory_tree(spark, tmp_path):
    for p, b in {"pkg/SKILL.md": b"---\r\nname: n\r\n---\r\n# Description\r\nd\r\n# Rest\r\nr", "pkg/a/b": b"1", "pkg/a-b/c": b"2", "pkg/a.txt": b"\xff\xfe ok", "pkg/sub/SKILL.md": b"kept", "other/x": b"", "pkg/big": b"z" * 200_001}.items():
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_bytes(b)
    p = readers.packages(readers.directory_files(spark, str(tmp_path)))
    rows = {r.package_dir: r for r in p.collect()}
    assert [f.path for f in rows["pkg"].package_files] == sorted(["a/b", "a-b/c", "a.txt", "big", "sub/SKILL.md"], key=lambda x: x.split("/"))
    big = next(f for f in rows["pkg"].package_files if f.path == "big")
    assert big.truncated and len(big.content) == 200_000 and rows["other"].has_md is False
    c = {r.skill_id: r for r in challenge.canonical_of(p, F.col("package_dir")).collect()}
    assert c["pkg"].first_layer.name == "n" and c["pkg"].skill_md.description_section.content == "d" and c["pkg"].skill_md.non_description == "# Rest\nr"


def test_configuration(tmp_path):
    (tmp_path / "c.yaml").write_text('a: {p: "${X:-d}/x", q: ["${Y}"]}\n')
    assert readers.load_config(str(tmp_path / "c.yaml"), ("a",), {"X": ""}) == {"a": {"p": "/x", "q": [""]}}
    with pytest.raises(ValueError):
        readers.load_config(str(tmp_path / "c.yaml"), ("b",))
    (tmp_path / "c.json").write_text(json.dumps({"a": 1}))
    assert readers.load_config(str(tmp_path / "c.json")) == {"a": 1}


def test_copy_and_first_rows(spark, tmp_path):
    for p in ("src/SKILL.md", "src/x/SKILL.md", "src/y", "to/y"):
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_text(p)
    pairs = spark.createDataFrame([(str(tmp_path / "src"), str(tmp_path / "to")), (str(tmp_path / "none"), "x")], "src string, dst string")
    total = lambda d: d.groupBy().sum("copied", "kept", "missing").first()
    assert tuple(total(writers.copy_missing(pairs, dry_run=True))) == (1, 1, 1) and not os.path.exists(tmp_path / "to/x")
    assert tuple(total(writers.copy_missing(pairs))) == (1, 1, 1) and tuple(total(writers.copy_missing(pairs))) == (0, 2, 1)
    assert os.path.exists(tmp_path / "to/x/SKILL.md") and (tmp_path / "to/y").read_text() == "to/y"
    c = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", 1, "b"), (None, 1, "n")], "skill_id string, ord int, v string")
    hold = spark.createDataFrame([("a",), ("c",)], "skill_id string")
    found = challenge.challenge_part(c, hold, [F.col("ord")])
    assert [(r.skill_id, r.v) for r in found.collect()] == [("a", "early")]
    assert {r.skill_id for r in challenge.train_part(c, hold).collect()} == {"b", None}


def test_streamed_records_are_added_once(spark, tmp_path):
    from millrace.streaming.incremental import run_new

    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.json").write_text('{"skill_id": "a"}\n{"skill_id": "a"}\n{"skill_id": null}\n')
    go = lambda: run_new(spark, str(tmp_path / "in"), "skill_id string", lambda d: d, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    go()
    (tmp_path / "in/2.json").write_text('{"skill_id": "a"}\n{"skill_id": "b"}\n')
    go()
    assert sorted(r.skill_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]


def test_model_paths():
    tree = {"a": {"x": "/m/x", "y": "downloading"}, "z": "/m/z"}
    assert readers.model_path(tree, "x") == "/m/x" and readers.model_path(tree, "z") == "/m/z"
    for key in ("y", "none"):
        with pytest.raises(ValueError):
            readers.model_path(tree, key)


def test_parity_order_of_balanced_views(spark):
    import random

    rows = [(f"r{i:03}", "s", "train", "positive" if i % 3 else "T1", f"t{i}") for i in range(60)]
    v = spark.createDataFrame(rows, "sample_id string, stage string, split string, label string, text string")
    got = {r.sample_id for r in balance.balanced(v, "cpt", seed=9, order="mt").collect()}
    want = set()
    for label, file in (("positive", "train.parquet"), ("t1", "train_t1.parquet")):
        own = [r[0] for r in rows if r[3].lower() == label]
        places = list(range(len(own)))
        if len(own) > 20:
            random.Random(f"9|{label}|{file}").shuffle(places)
        want |= {own[i] for i in places[:20]}
    assert got == want


def test_rows_with_equal_keys_stay_together(spark):
    rows = [("a", "s", "train", "positive"), ("a", "s", "train", "positive"), ("b", "s", "train", "positive"), (None, "s", "train", "positive"), ("c", "s", "train", "t1"), ("d", "s", None, "t1")]
    v = spark.createDataFrame(rows, "sample_id string, stage string, split string, label string")
    n = {r.balanced_label: r["count"] for r in balance.balanced(v, "cpt").groupBy("balanced_label").count().collect()}
    assert n["t1"] == 1 and n["positive"] in (1, 2)
    assert balance.balanced(v.where("false"), "cpt").count() == 0


def test_attempts_have_outcomes(spark):
    tag = lambda x, t: f"<{t}>\n{x}\n</{t}>"
    texts = [tag("m", "METADATA") + "\n" + tag("pip install numpy", "INSTRUCTION"), tag("m", "METADATA") + "\n" + tag("nothing here", "INSTRUCTION"), tag("m", "METADATA"), tag("m", "METADATA") + "\n" + tag("pip install numpy " + "x" * 17_000, "INSTRUCTION"), None]
    p = spark.createDataFrame([(f"a{i}", t, "cpt", "train", "stage1") for i, t in enumerate(texts)], "anchor_skill_id string, text string, pool string, split string, stage string")
    got = {r.anchor_skill_id: r.outcome for r in identifiers.attempts(p).collect()}
    assert got == {"a0": "emitted", "a1": "no_hit", "a2": "empty_layer", "a3": "over_budget", "a4": "empty_layer"}
    got = {r.anchor_skill_id: r.outcome for r in spans.attempts(p).collect()}
    assert got["a2"] == "empty_layer" and got["a1"] == "no_rewrite" and identifiers.substituted(p).count() == 1


def test_older_forms(spark):
    df = spark.createDataFrame([("a", " n ", "d" * 30, None, "f", "x")], "skill_id string, name string, description_text string, skill_md_non_description string, package_files_text string, full_text string")
    r = samples.stage_row(df, 20).first()
    assert (r.stage_name, r.stage_markdown, r.packed_skill_len, r.stage_description) == ("n", "", 1, "d" * 7 + "\n\n[TRUNCATED]")
    p = df.select(challenge.match_prompt(F.col("name"), F.col("description_text"), F.col("skill_md_non_description"), 0).alias("p")).first().p
    assert p.prompt.startswith("Skill name: n\n\nEvidence:\nddd") and p.evidence == "d" * 30


def test_hot_keys_are_spread(spark):
    from millrace.session import salted_join

    rows = [("hot" if i % 3 else f"k{i}", f"s{i}") for i in range(300)] + [(None, "n"), ("hot", None)]
    many = spark.createDataFrame(rows, "k string, v string")
    one = spark.createDataFrame([("hot", 1), ("k0", 2), ("k3", 3), ("none", 4), (None, 5)], "k string, w int")
    want = sorted(map(str, many.join(one, ["k"]).collect()))
    assert sorted(map(str, salted_join(many, one, ["k"], "v", hot_rows=50, salts=7).collect())) == want
    assert sorted(map(str, salted_join(many, one, ["k"], "v").collect())) == want and len(want) == 203
