import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import cosine_join, leaks, near_duplicates, overlap, words

RNG = random.Random(4)
VOCAB = [f"w{i}" for i in range(300)]


def edited(text, n):
    ws = text.split()
    for _ in range(n):
        ws[RNG.randrange(len(ws))] = RNG.choice(VOCAB)
    return " ".join(ws)


def plain_words(t):
    drop = {0xAD, 0x2060, 0xFEFF, *range(0x200B, 0x2010)}
    t = "".join(c for c in unicodedata.normalize("NFKC", t or "") if ord(c) not in drop).lower()
    out, now = [], ""
    for c in t + " ":
        if c.isalnum():
            now += c
        elif now:
            out.append(now)
            now = ""
    return out


def sets(t, k=3):
    w = plain_words(t)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def likeness(a, b, k=3):
    a, b = sets(a, k), sets(b, k)
    return len(a & b) / len(a | b) if a and b else 0


def test_words_against_plain_code():
    for t in [None, "", "  ", "A_b c-d", "ﬁne ＡＢＣ １２", "so\u00adft zero\u200bwidth", "İstanbul Straße ñ", "日本語 text", "a\u0301b", "x²y ①"]:
        assert words.words(t) == plain_words(t), t


def corpus(n=40):
    base = [" ".join(RNG.choices(VOCAB, k=60)) for _ in range(n)]
    rows = [(f"b{i}", t) for i, t in enumerate(base)] + [(f"e{i}-{k}", edited(base[i], k)) for i in range(15) for k in (1, 2, 4, 8)]
    rows += [("copy1", base[0]), ("copy2", base[0].upper()), ("twice", base[1]), ("twice", base[1]), ("two", base[2]), ("two", base[3]), ("null", None), ("empty", ""), ("short", "only two"), ("long", base[4] + " x y z" * 3000), (None, base[0])]
    return rows


@pytest.mark.parametrize("hot", [500, 2])
def test_near_duplicates_against_brute_force(spark, hot):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1) for r in rows], "id string, text string, cid int")  # a clashing extra column
    got = {(r.id_a, r.id_b): r.likeness for r in near_duplicates.near_pairs(df, 0.6, hot=hot).collect()}
    want = {}
    for i, (a, s) in enumerate(rows):
        for b, t in rows[i + 1 :]:
            if a and b and a != b and (j := likeness(s, t)) >= 0.6:
                want[min(a, b), max(a, b)] = max(j, want.get((min(a, b), max(a, b)), 0))
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_groups(spark):
    rows = corpus()
    g = {}
    for r in near_duplicates.near_groups(spark.createDataFrame(rows, "id string, text string"), 0.6).collect():
        g.setdefault(r.id, []).append(r)
    assert {r.class_id for r in g["copy1"]} == {r.class_id for r in g["copy2"]} == {r.class_id for r in g["b0"]}
    assert g["copy1"][0].copies == 3 and "null" not in g and "short" not in g
    links = [b for b, t in rows if b and b != "copy1" and likeness(rows[0][1], t) >= 0.6]
    assert g["copy1"][0].links == len(set(links))
    assert g["e0-1"][0].group_id == g["b0"][0].group_id != g["b9"][0].group_id


def test_components_against_union_find(spark):
    n = 200
    edges = [(RNG.randrange(n), RNG.randrange(n)) for _ in range(120)] + [(i, i + 1) for i in range(150, 190)]
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    df = spark.createDataFrame([(a, b) for a, b in edges] + [(b, a) for a, b in edges], "u int, v int")
    got = {r.cid: r.root for r in near_duplicates.components(df).collect()}
    assert got == {v: find(v) for e in edges if e[0] != e[1] for v in e}
    assert near_duplicates.components(df.where("false")).count() == 0


def test_leaks_against_brute_force(spark):
    items = [(f"i{k}", " ".join(RNG.choices(VOCAB, k=40))) for k in range(12)] + [("none", None), ("few", "a b c"), ("twin", None)]
    items[-1] = ("twin", items[0][1])
    docs = []
    for k in range(60):
        t = RNG.choices(VOCAB, k=50)
        if k % 3 == 0:
            w, n = items[k % 12][1].split(), RNG.choice([11, 12, 13, 14, 20])
            at = RNG.randrange(len(w) - n)
            t[20:20] = [x.upper() if RNG.random() < 0.3 else x for x in w[at : at + n]]
        docs.append((f"d{k}", " ".join(t)))
    docs += [docs[0], ("null", None), ("", "")]
    got = {(r.item_id, r.id): r.words for r in leaks.leaked_passages(spark.createDataFrame(items, "id string, text string"), spark.createDataFrame(docs, "id string, text string")).collect()}

    def longest(a, b):
        a, b, best = plain_words(a), plain_words(b), 0
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                    n += 1
                best = max(best, n)
        return best

    want = {(i, d): n for i, x in items for d, y in docs if (n := longest(x, y)) >= 13}
    assert got == want and len(want) > 5


def test_cosine_join_against_brute_force(spark):
    g = np.random.default_rng(3)
    rows = []
    for i in range(120):
        base = i // 3
        t = np.unique(np.concatenate([np.random.default_rng(base).integers(0, 400, 30), g.integers(0, 400, 4), [999]]))  # a term in all
        w = np.ones(len(t)) + g.random(len(t))
        w /= np.sqrt((w * w).sum())
        rows.append((i, [int(x) for x in t], [float(x) for x in w]))
    df = spark.createDataFrame(rows + [(900, [], []), (901, None, None), (None, [1], [1.0])], "id int, terms array<bigint>, weights array<double>")
    left, right = df.where("id is null or id % 2 = 0"), df.where("id % 2 = 1")
    dot = lambda a, b: sum(dict(zip(a[1], a[2])).get(t, 0) * w for t, w in zip(b[1], b[2]))
    for threshold in (0.5, 0.8, 1.0):
        for l, r, cross in ((left, right, True), (df, None, False)):
            got = {(x.id_a, x.id_b): x.dot for x in cosine_join.cosine_join(l, r, threshold).collect()}
            want = {(a[0], b[0]): d for a in rows for b in rows if (a[0] % 2 == 0 and b[0] % 2 == 1 if cross else a[0] < b[0]) and (d := dot(a, b)) >= threshold - 1e-9}
            assert got.keys() == want.keys()
            assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    with pytest.raises(ValueError):
        cosine_join.cosine_join(left, right, 0)


def test_split_overlaps_against_brute_force(spark):
    base = [" ".join(RNG.choices(VOCAB, k=50)) for _ in range(30)]
    rows = []
    for i, t in enumerate(base):
        for k, s in enumerate(["train", "Val ", "test", "unseen", None, "other"]):
            rows.append((f"{i}-{k}", s, edited(t, RNG.choice([0, 1, 2, 3, 5]))))
    rows += [("dup", "train", base[0]), ("dup", "train", base[0]), ("n", "train", None), ("e", "test", ""), (None, "test", base[0])]
    df = spark.createDataFrame(rows, "id string, split string, text string").withColumn("split", overlap.clean("split"))
    got = {(r.id_a, r.id_b) for r in overlap.split_overlaps(df, 0.7).collect()}
    tr = [(a, t) for a, s, t in rows if s == "train"]
    ev = [(a, t) for a, s, t in rows if s and s.strip().lower() in ("val", "test", "unseen") and a]
    want = {(min(a, b), max(a, b)) for a, x in tr for b, y in ev if likeness(x, y) >= 0.7}
    assert got == want and want
    n = {r.id: r.links for r in overlap.overlap_rows(df, 0.7).collect()}
    assert n == {a: len({p for p in want if a in p}) for p in want for a in p}
    details = spark.createDataFrame([(a, "anchor", ["anchor", "donor", None]) for a, _, _ in rows], "id string, anchor string, sources array<string>")
    c = {(r.source_kind, r.split): r for r in overlap.overlap_counts(df, details, 0.7).collect()}
    assert c["anchor", "train"].rows == len({a for a, _ in tr if a in n}) == c["donor", "train"].rows
    assert overlap.split_overlaps(df.where("false"), 0.7).count() == 0


def test_tables_merge_as_trees_and_grow(spark, monkeypatch):
    """No group holds more pages than the fan-in, however many tasks there are; a filled table is made anew."""
    rows = [(i, [int(x) for x in np.random.default_rng(i).integers(-(2**62), 2**62, 60)]) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, terms array<bigint>").repartition(150).cache()
    want, stats = cosine_join.vocabulary_table(df, 20), cosine_join.term_stats(df, 16)
    seen, merged = [], cosine_join.merged
    groups = spark.sparkContext.accumulator(0)

    def watched(pages, both):
        def counted(t):
            groups.add(int(t.num_rows > cosine_join.FAN_IN))
            return both(t)

        seen.append(1)
        return merged(pages, counted)

    monkeypatch.setattr(cosine_join, "merged", watched)
    assert cosine_join.vocabulary_table(df, 20) == want and np.array_equal(cosine_join.term_stats(df, 16)[0], stats[0]) and groups.value == 0
    assert stats[0].sum() == 400 * 60 and sum(map(int.bit_count, want)) <= 400 * 60
    monkeypatch.setattr(cosine_join, "TABLE_MOST", 20)
    monkeypatch.setattr(cosine_join, "STAT_MOST", 16)
    assert cosine_join.table_bits(cosine_join.vocabulary_table(df, 14)) > 14 and len(cosine_join.term_stats(df, 14)[0]) > 1 << 14
    a, b = cosine_join._shared_slots(stats, cosine_join.term_stats(df, 15))
    assert np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1])


def test_longest_shared_is_linear_and_right():
    import time

    def slow(a, b, span):
        return max(((n, -i, -j) for i in range(len(a)) for j in range(len(b)) for n in [next((k for k in range(min(len(a) - i, len(b) - j)) if a[i + k] != b[j + k]), min(len(a) - i, len(b) - j))] if n >= span), default=(0, 0, 0))[0]

    for _ in range(200):
        a, b = ([RNG.choice("xyz") for _ in range(RNG.randint(0, 25))] for _ in range(2))
        n, i, j = leaks.longest_shared(a, b, 3)
        assert n == slow(a, b, 3) and a[i : i + n] == b[j : j + n]
    began = time.perf_counter()
    assert leaks.longest_shared(["a"] * 20_000, ["a"] * 20_000)[0] == 20_000 and leaks.longest_shared(["a", "b"] * 10_000, ["b", "a", "c"] * 7_000)[0] == 0
    assert time.perf_counter() - began < 5


def test_weighted_overlaps_against_brute_force(spark):
    common = " ".join(RNG.choices(VOCAB, k=30))
    rows = [(f"t{i}", "train", common + " " + " ".join(RNG.choices(VOCAB, k=30))) for i in range(25)]
    rows += [(f"h{i}", ("val", "test", "unseen")[i % 3], edited(rows[i][2], i % 4)) for i in range(12)] + [(f"o{i}", "val", common + " " + " ".join(RNG.choices(VOCAB, k=30))) for i in range(10)]
    rows += [("copy", "train", rows[0][2]), ("none", None, rows[0][2]), ("null", "val", None), ("short", "val", "a b")]
    got = sorted((r.cosine, r.train_copies, r.held_copies) for r in overlap.weighted_overlaps(spark.createDataFrame(rows, "id string, split string, text string"), 0.6).collect())
    classes = {}
    for i, s, t in rows:
        if s and t and sets(t):
            classes.setdefault((s == "train", frozenset(sets(t))), set()).add(i)
    used = [t for i, s, t in rows if s and t]
    n, freq = len(used), {}
    for t in used:
        for x in sets(t):
            freq[x] = freq.get(x, 0) + 1
    w = lambda x: np.log1p(n / freq[x])
    norm = lambda c: np.sqrt(sum(w(x) ** 2 for x in c))
    want = sorted((float(d), len(classes[a]), len(classes[b])) for a in classes if a[0] for b in classes if not b[0] if (d := sum(w(x) ** 2 for x in a[1] & b[1]) / norm(a[1]) / norm(b[1])) >= 0.6)
    assert want and len(got) == len(want) and np.allclose([g[0] for g in got], [x[0] for x in want], atol=2e-3)  # runs may share a slot
    assert sorted(g[1:] for g in got) == sorted(x[1:] for x in want)


def shuffled_bytes(spark):
    import time

    sc = spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty(30_000)
    time.sleep(1)  # the store is brought up to date now and then
    found = sc.statusStore().executorList(False)
    return sum(found.apply(i).totalShuffleWrite() for i in range(found.size()))


def test_sets_are_not_shuffled_where_nothing_can_be_pruned(spark, monkeypatch):
    """p4 in a large table: nearly each run occurs on the other side, so no row can be dropped by the vocabulary."""
    g = random.Random(8)
    pool = [" ".join(g.choices(VOCAB, k=12)) for _ in range(3000)]
    rows = [(f"r{i}", g.choice(["train", "train", "val"]), " ".join(g.choices(pool, k=30))) for i in range(1200)]
    rows += [(f"c{i}", "test", t.replace("w1 ", "w2 ")) for i, (_, s, t) in enumerate(rows[:60]) if s == "train"] + [("again", "train", rows[0][2]), ("again", "test", rows[0][2])]
    df = spark.createDataFrame(rows, "id string, split string, text string").repartition(2)
    for name, bits in (("TABLE_MOST", 20), ("STAT_BITS", 14), ("STAT_MOST", 14)):  # tables small beside the sets, as they are in a large table
        monkeypatch.setattr(cosine_join, name, bits)
    monkeypatch.setattr(cosine_join.vocabulary_table, "__defaults__", (20,))
    monkeypatch.setattr(cosine_join.term_stats, "__defaults__", (14, None))
    held = {x for _, s, t in rows if s != "train" for x in sets(t)}
    assert sum(len(held & sets(t)) > 0.7 * len(sets(t)) for _, s, t in rows if s == "train") > 700
    before = shuffled_bytes(spark)
    got = {(r.id_a, r.id_b) for r in overlap.split_overlaps(df, 0.7).collect()}
    written = shuffled_bytes(spark) - before
    every = [(i, s, sets(t)) for i, s, t in rows]
    want = {(min(a, b), max(a, b)) for a, s, x in every if s == "train" for b, r, y in every if r != "train" and a != b and len(x & y) >= 0.7 * len(x | y)}
    assert got == want and len(want) > 30
    assert written < 2 * sum(8 * len(x) for _, _, x in every)  # 1.1 times; 4 when sets were shuffled


def test_sketches_bound_what_is_shared(spark):
    g = np.random.default_rng(5)
    vectors = [(i, np.unique(g.integers(-(2**62), 2**62, n))) for i, n in enumerate([1, 3, 40, 300, 300, 5000])]
    vectors += [(10 + i, np.unique(np.concatenate([v[: len(v) * 4 // 5], g.integers(-(2**62), 2**62, 9)]))) for i, v in vectors]
    df = spark.createDataFrame([(i, 1.0, [int(x) for x in v]) for i, v in vectors], "id int, norm double, terms array<bigint>")
    held = {r.id: (r.k, r.bits) for r in cosine_join.sketches(df).collect()}
    for i, v in vectors:
        for j, u in vectors:
            most, true = cosine_join.most_shared(*held[i], *held[j]), len(np.intersect1d(u, v))
            assert true <= most and (i % 10 == j % 10 or min(len(u), len(v)) < 300 or most < 0.7 * min(len(u), len(v)) or len(u) != len(v)), (i, j)
