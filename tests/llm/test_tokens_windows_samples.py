import random

import numpy as np
import pytest
import tiktoken

from millrace.llm import cube_sample, packing, tokenize

RNG = random.Random(8)
RANKS = f"{tokenize.TOKENIZERS}/byte_bpe_50k.tiktoken"


def texts():
    al = "abcdefgh  \n\t'.,-=_éß漢字🚀あ\u200b0123aaaeee\r"
    out = ["".join(RNG.choice(al) for _ in range(RNG.randint(0, 200))) for _ in range(300)]
    out += ["".join(chr(RNG.choice([RNG.randint(0, 126), RNG.randint(160, 0x2FFF), RNG.randint(0x10000, 0x1F9FF)])) for _ in range(40)) for _ in range(200)]
    return out + ["", " ", "a" * 3000, "=-" * 2000, " " * 1500, "\0abc \0abc", "<|endoftext|> x", "don't we'll", "a\n b\n\n  c \n", "x" + "\u00a0 y"]


def test_ids_against_the_public_encoder(spark):
    ref = tiktoken.Encoding("own", pat_str=tokenize.PATTERN, mergeable_ranks=tokenize.read_ranks(RANKS), special_tokens={})
    rows = list(enumerate([*texts(), None]))
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id bigint, text string, ids string").drop("ids")
    got = {r.doc_id: r.ids for r in tokenize.encode(df).collect()}
    assert got == {i: None if t is None else ref.encode_ordinary(t) for i, t in rows}
    n = {r.doc_id: r.size for r in tokenize.encode(df, out="size", count_only=True).collect()}
    assert n == {i: None if v is None else len(v) for i, v in got.items()}
    assert tokenize.encode(df.where("false")).count() == 0


def test_round_trip():
    enc = tokenize.Encoder(tokenize.read_ranks(RANKS))
    token = {v: k for k, v in enc.ranks.items()}
    for t in texts():
        ids, n = enc.encode([t])
        assert b"".join(token[int(i)] for i in ids).decode() == t and n[0] == len(ids)


def test_bounds_hold():
    for _ in range(60):
        cap = RNG.choice([10, 50, 100])
        sizes = np.array([RNG.randint(1, cap) for _ in range(RNG.randint(1, 12))])
        w = packing.best_fit_decreasing(sizes, cap)
        assert np.bincount(w, weights=sizes).max() <= cap
        s, n = np.unique(sizes, return_counts=True)
        low = packing.lower_bound(s, n, cap)
        assert -(-int(sizes.sum()) // cap) <= low <= optimum(sizes.tolist(), cap) <= w.max() + 1


def optimum(sizes, cap):
    sizes, best = sorted(sizes, reverse=True), [len(sizes)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= cap and bins[k] not in bins[:k]:
                go(i + 1, [*bins[:k], bins[k] + sizes[i], *bins[k + 1 :]])
        go(i + 1, [*bins, sizes[i]])

    go(0, [])
    return best[0]


@pytest.mark.parametrize("per_part", [10_000, 40])
def test_windows_hold_everything_once(spark, per_part):
    cap = 100
    rows = [(i, RNG.choice([0, 1, 30, 51, 60, 99, 100, 101, 250, RNG.randint(1, 100)])) for i in range(400)] + [(900, None), (901, 1000)]
    out, report = packing.fill_windows(spark.createDataFrame(rows, "id int, size int"), cap, per_part)
    got = out.collect()
    load, per = {}, {}
    for r in got:
        per.setdefault(r.id, []).append(r)
        if r.window_id:
            load.setdefault(r.window_id, []).append(r)
    for i, n in rows:
        pieces = sorted(per[i], key=lambda r: r.piece)
        assert sum(r.size for r in pieces) == (n or 0)
        assert [r.start for r in pieces] == [k * cap for k in range(len(pieces))]
        assert len(pieces) == max(1, -(-(n or 0) // cap))
        assert (pieces[0].window_id is None) == (not n)
    for rs in load.values():
        rs.sort(key=lambda r: r.position)
        at = 0
        for k, r in enumerate(rs):
            assert (r.position, r.window_start) == (k, at)
            at += r.size
        assert at <= cap
    assert report["windows"] == len(load) >= report["lower_bound"] and report["tokens"] == sum(n or 0 for _, n in rows)
    empty, rep = packing.fill_windows(spark.createDataFrame([], "id int, size int"), cap)
    assert empty.count() == 0 and rep["windows"] == 0


def test_exchange_never_takes_more_windows(spark):
    rows = [(i, RNG.choice([34, 35, 36, 33, 65, 66])) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, size int")
    assert packing.fill_windows(df, 100, 30)[1]["windows"] <= packing.fill_windows(df, 100, 30, rounds=0)[1]["windows"]


def test_flight_keeps_sums():
    g = np.random.default_rng(1)
    pi, cat = g.random(500), g.integers(0, 6, 500)
    out = cube_sample.fly(pi, cat, np.random.default_rng(2).random(500))
    for c in range(6):
        assert abs(out[cat == c].sum() - pi[cat == c].sum()) < 1e-6
        assert ((out[cat == c] > 0) & (out[cat == c] < 1)).sum() <= 1
    mean = np.mean([cube_sample.fly(np.full(10, 0.3), np.zeros(10, int), np.random.default_rng(k).random(10))[0] for k in range(3000)])
    assert abs(mean - 0.3) < 0.05  # probabilities are kept


def test_sample_meets_targets(spark):
    rows = [(f"r{i}", "s", "train" if i % 3 else "val", "abc"[i % 7 % 3]) for i in range(900)]
    rows += rows[:50] + [("x", None, "train", "a"), ("y", "s", "train", None), (None, "s", "val", "a")]
    df = spark.createDataFrame(rows, "id string, stage string, split string, label string").repartition(5)
    want = [("s", "train", "a", 0.5, 5, 100), ("s", "train", "b", 0.4, 5, 100), ("s", "train", "c", 0.1, 20, 100), ("s", "val", "a", 1.0, 0, 5000), ("s", "val", "z", 0.0, 3, 10), ("s", "val", "b", 0.0, 0, 10)]
    targets = spark.createDataFrame(want, "stage string, split string, label string, target_share double, min_rows bigint, sample_rows bigint")
    sample, report = cube_sample.draw(df, targets)
    got, r = sample.collect(), {(x.split, x.label): x for x in report.collect()}
    assert len({x.id for x in got}) == len(got) and {tuple(x) for x in got} <= set(rows)
    have = {k: len({i for i, stage, s, l in rows if (s, l) == k and i and stage}) for k in r}
    for k, x in r.items():
        need = max(x.min_rows, round(x.target_share * x.sample_rows))
        assert (x.wanted, x.available, x.drawn, x.missing) == (need, have[k], min(need, have[k]), need - min(need, have[k]))
    empty, rep = cube_sample.draw(df.where("false"), targets)
    assert empty.count() == 0 and all(x.drawn == 0 for x in rep.collect())




def test_sample_does_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(cube_sample, "PART", 100)  # two levels
    rows = [(f"r{i}", "s", "train" if i % 3 else "val", "abc"[i % 7 % 3]) for i in range(3000)]
    want = [("s", s, x, share, 5, 200) for s in ("train", "val") for x, share in zip("abc", (0.5, 0.35, 0.15))]
    targets = spark.createDataFrame(want, "stage string, split string, label string, target_share double, min_rows bigint, sample_rows bigint")
    seen, old = [], spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n, batch in ((4, 10_000), (13, 37)):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            df = spark.createDataFrame(rows, "id string, stage string, split string, label string").repartition(n + 2)
            seen.append({r.id for r in cube_sample.draw(df, targets)[0].collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert seen[0] == seen[1] and len(seen[0]) == 400
    assert {r.id for r in cube_sample.draw(df, targets, seed=8)[0].collect()} != seen[0]
