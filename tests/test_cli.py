import json

import pytest
from pyspark.sql import functions as F

from millrace import cli


def test_stages_follow_each_other(spark, tmp_path, capsys):
    rows = []
    for i in range(8):
        body = "\n".join(f"Step {k}: run pip install numpy --force if x == {k}" for k in range(12))
        files = [{"path": f"f{k}.py", "content": "import pandas\n" * 30, "size_bytes": 400, "truncated": False} for k in range(i % 3)]
        rows.append({"skill_id": f"s{i}", "first_layer": {"name": f"n{i}", "description": "does things"}, "skill_md": {"description_section": {"found": False, "heading": "", "content": ""}, "non_description": body}, "package_files": files})
    (tmp_path / "in.jsonl").write_text("\n".join(map(json.dumps, rows)) + "\n")
    (tmp_path / "v.csv").write_text("skill_id,overall_class,alignment_class\ns0,SAFE,ALIGNED\ns0,malicious,ALIGNED\ns1,SAFE,aligned\n")
    (tmp_path / "ids.csv").write_text("skill_id\ns2\n")
    at = lambda n: str(tmp_path / n)
    cli.main(["normalize", "--in", at("in.jsonl"), "--out", at("n"), "--verdicts", at("v.csv")])
    n = spark.read.parquet(at("n"))
    assert {r.skill_id for r in n.collect()} == {f"s{i}" for i in range(1, 8)}  # the last verdict of s0 counts
    assert [r.value for r in spark.read.text(at("n_excluded_ids")).collect()] == ["s0"]
    with pytest.raises(Exception):
        cli.main(["normalize", "--in", at("in.jsonl"), "--out", at("n")])
    cli.main(["phase1", "--in", at("n"), "--out", at("p")])
    cli.main(["variants", "--in", at("p"), "--out", at("v")])
    cli.main(["identify", "--in", at("v"), "--out", at("c")])
    for _ in range(2):  # a resumed run adds nothing and loses nothing
        cli.main(["rewrite", "--in", at("v"), "--out", at("a")])
    a = spark.read.parquet(at("a"))
    assert a.count() == a.select("anchor_skill_id", "stage", "target_layer").distinct().count() > 0
    cli.main(["balance", "--in", at("v"), "--out", at("b")])
    cli.main(["pairs", "--in", at("v"), "--out", at("q")])
    cli.main(["scrub", "--in", at("v"), "--out", at("w"), "--ids", at("ids.csv")])
    left = spark.read.parquet(at("w")).collect()
    assert left and all("s2" not in r.source_skill_ids for r in left)
    assert spark.read.parquet(at("q")).count() > 0 and {r.view for r in spark.read.parquet(at("b")).collect()} <= {"cpt", "contrastive"}
    cli.main(["stats", "--in", at("v")])
    for name, stage in (("n", "normalize"), ("p", "phase1"), ("v", "variants"), ("c", "identify"), ("a", "rewrite"), ("b", "balance"), ("q", "pairs"), ("w", "scrub")):
        m = json.loads((tmp_path / name / "_manifest.json").read_text())
        assert m["phase_name"] == stage and m["files"] and m["stats"]["rows"] == spark.read.parquet(at(name)).count()
    assert {v["version"] for v in json.loads((tmp_path / "registry.json").read_text())["versions"]} >= {"n", "p", "v"}
    assert json.loads((tmp_path / "c/_stats.json").read_text())["outcomes"] and [r.value for r in spark.read.text(at("n_skill_ids")).collect()] == [f"s{i}" for i in range(1, 8)]
    with pytest.raises(FileNotFoundError):  # a verdict path that isn't there must not switch the filter off
        cli.main(["normalize", "--in", at("in.jsonl"), "--out", at("n2"), "--verdicts", "file://" + at("none.csv")])
    cli.main(["normalize", "--in", at("in.jsonl"), "--out", at("n3"), "--verdicts", "file://" + at("v.csv")])
    assert spark.read.parquet(at("n3")).count() == 7
    assert "positive" in capsys.readouterr().out


def _trees(tmp_path):
    for p, t in {"a/SKILL.md": "---\nname: A\ndescription: does a\n---\n# Use\nrun it", "a/x.py": "print(1)", "b/skill.md": "# Description\nb it is\n# Use\ngo", "c/y.txt": "no markdown"}.items():
        (tmp_path / "pk" / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "pk" / p).write_text(t)
    (tmp_path / "r.csv").write_text("skill_id,source,final_safe,final_align,hsb_tier\na,Collected,safe,aligned,1\nb,,malicious,Misaligned ,\nc,x,SAFE,ALIGNED,\nz,x,SAFE,ALIGNED,\nd,x,SAFE,,\n")


def test_evaluation_and_classifier_stages(spark, tmp_path):
    _trees(tmp_path)
    at = lambda n: str(tmp_path / n)
    cli.main(["eval", "--in", at("pk"), "--reviewed", at("r.csv"), "--out", at("ev/v1")])
    e = {r.skill_id: r for r in spark.read.parquet(at("ev/v1/eval")).collect()}
    assert set(e) == {"a", "b", "c"} and e["a"].skill_text == "does a\n\n---\n\n# Use\nrun it" and (e["a"].source, e["b"].source, e["b"].alignment_class) == ("collected", "unknown", "MISALIGNED")
    c = {r["skill_id"]: r for r in (json.loads(x.value) for x in spark.read.text(at("ev/v1/canonical")).collect())}
    assert c["a"]["gold"] == {"final_safe": "SAFE", "final_align": "ALIGNED"} and c["a"]["scan"]["hsb_tier"] == "1" and c["a"]["package_files"][0]["path"] == "x.py"
    stats = json.loads((tmp_path / "ev/v1/_stats.json").read_text())
    assert stats["rows"] == 3 and stats["missing_package"] == 2 and stats["by_source_reviewed"] == {"collected": 1, "unknown": 1, "x": 3}
    cli.main(["eval", "--in", at("pk"), "--reviewed", at("r.csv"), "--out", at("ev/v2"), "--limit", "1", "--format", "csv"])
    assert (tmp_path / "ev/v2/eval").exists() and json.loads((tmp_path / "ev/v2/_stats.json").read_text())["rows"] == 1
    cli.main(["sft", "--in", at("pk"), "--reviewed", at("r.csv"), "--out", at("sft/v1")])
    rows = {r.skill_id: r for r in spark.read.parquet(at("sft/v1/classifier")).collect()}
    assert set(rows) == {"a", "b"} and rows["b"].candidate_description == "b it is" and rows["a"].output_version == "v1"
    assert json.loads((tmp_path / "sft/v1/_stats.json").read_text())["skipped"] == {"no_label": 1, "missing_package": 1, "no_text": 1}
    chat = [json.loads(r.value) for r in spark.read.text(at("sft/v1/chat")).collect()]
    assert {c["metadata"]["skill_id"] for c in chat} == {"a", "b"} and all(len(c["messages"]) == 3 for c in chat)
    cli.main(["add-columns", "--in", at("sft/v1/classifier"), "--out", at("sft/v2")])
    (tmp_path / "ids.csv").write_text("skill_id\na\n")
    cli.main(["scrub-all", "--in", str(tmp_path), "--ids", at("ids.csv"), "--versions", "sft=v1:v3"])
    assert [r.skill_id for r in spark.read.parquet(at("sft/v3/classifier")).collect()] == ["b"] and spark.read.text(at("sft/v3/chat")).count() == 1
    m = json.loads((tmp_path / "sft/v3/_manifest.json").read_text())
    assert m["stats"]["totals"] == {"total": 4, "kept": 2, "dropped": 2} and m["derived_from"] == "v1"
    with pytest.raises(FileExistsError):
        cli.main(["scrub-all", "--in", str(tmp_path), "--ids", at("ids.csv"), "--versions", "sft=v1:v3"])
    cli.main(["stats-all", "--in", str(tmp_path), "--versions", "sft=v1", "sft=v3", "sft=none", "--out", at("report.json")])
    rep = json.loads((tmp_path / "report.json").read_text())
    assert [v["total_rows"] for v in rep["sft"]] == [4, 2] and rep["sft"][0]["label_dist"]["all"] == {"1": 1, "0": 1}


def test_canonical_splits_and_restored_packages(spark, tmp_path):
    _trees(tmp_path)
    at = lambda n: str(tmp_path / n)
    lines = ['{"skill_id": "k1", "v": 1}', '{"skill_id": "a", "v": 1}', "{broken", '{"skill_id": "a", "v": 2}', '{"v": 3}']
    (tmp_path / "in.jsonl").write_text("\n".join(lines) + "\n")
    (tmp_path / "ids.csv").write_text("skill_id\nb\na\nnowhere\n")
    cli.main(["split-train", "--in", at("in.jsonl"), "--ids", at("ids.csv"), "--out", at("train")])
    assert [r.value for r in spark.read.text(at("train")).collect()] == [lines[0]]
    cli.main(["split-challenge", "--in", at("in.jsonl"), "--ids", at("ids.csv"), "--packages", at("pk"), "--out", at("chal")])
    got = [json.loads(r.value) for r in spark.read.text(at("chal")).orderBy(F.input_file_name()).collect()]
    assert [g["skill_id"] for g in got] == ["b", "a"] and got[1] == {"skill_id": "a", "v": 1}
    assert json.loads((tmp_path / "chal/_stats.json").read_text()) == {"rows": 2, "from_canonical": 1, "local": 1, "missing": 1, "malformed": 2}
    (tmp_path / "store/a/files/deep").mkdir(parents=True)
    (tmp_path / "store/a/files/deep/z").write_text("z")
    (tmp_path / "store/a/files/x.py").write_text("other")
    for dry in (["--dry-run"], []):
        cli.main(["restore", "--in", at("store"), "--reviewed", at("r.csv"), "--out", at("pk"), *dry])
        assert (tmp_path / "pk/a/deep/z").exists() == (not dry)
    assert (tmp_path / "pk/a/x.py").read_text() == "print(1)"
