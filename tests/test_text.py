import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import hashing, text

SPACES = "".join(chr(c) for c in [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])


def plain_clean(t):
    t = (t or "").replace("\r\n", "\n").replace("\r", "\n").replace("\0", "")
    t = "\n".join(re.sub("[ \t]+", " ", x).rstrip(SPACES) for x in t.split("\n")).strip(SPACES)
    return re.sub("\n{3,}", "\n\n", t)


def plain_clip(t, n):
    if n <= 0 or len(t) <= n:
        return t
    head = t[:n].rstrip(SPACES)
    if len(head) + 13 > n:
        head = head[: max(0, n - 13)].rstrip(SPACES)
    return head + "\n\n[TRUNCATED]"


def test_the_space_class_is_pythons():
    assert sorted(SPACES) == sorted(chr(c) for c in range(0x110000) if chr(c).isspace())


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab \t\r\n\x0b\x1c\x85\xa0  　é🚀"), max_size=40), min_size=1, max_size=40))
def test_clean_and_clip_against_plain_code(spark, texts):
    rows = [(i, t) for i, t in enumerate([*texts, None, "", "  "])]
    df = spark.createDataFrame(rows, "i int, t string").select("i", text.clean(F.col("t")).alias("c"))
    for n in (0, 5, 13, 14, 20):
        for r in df.select("i", "c", text.clip(F.col("c"), n).alias("k"), text.clean(F.col("c")).alias("again")).collect():
            assert r.c == plain_clean(rows[r.i][1])
            assert r.again == r.c
            assert r.k == plain_clip(r.c, n)


def test_layers(spark):
    t = "<METADATA>\na\n</METADATA>\n<INSTRUCTION>\nb </INSTRUCTION> c\n</INSTRUCTION>\nx\n</INSTRUCTION>"
    df = spark.createDataFrame([(t,), ("plain",), (None,)], "t string")
    got = df.select(text.layer_of(F.col("t"), "I").alias("i"), text.layer_of(F.col("t"), "R").alias("r"), text.inner(F.lit("<RESOURCE>\nq\n</RESOURCE>"), "R").alias("q"), text.inner(F.lit("bare"), "R").alias("bare")).collect()
    assert [(r.i, r.r) for r in got] == [("b </INSTRUCTION> c", ""), ("", ""), ("", "")]
    assert (got[0].q, got[0].bare) == ("q", "bare")
    swapped = df.where("t like '<%'").select(text.replace_layer(F.col("t"), "stage1", "M", F.lit("new")).alias("s")).first().s
    assert swapped == "<METADATA>\nnew\n</METADATA>\n<INSTRUCTION>\nb </INSTRUCTION> c\n</INSTRUCTION>"


def test_description_section(spark):
    rows = ["intro\n## Description\nwhat it does\n# Next\nrest", "# DESCRIPTION \nall", "no heading", "", "a\n\n\n\n\nb"]
    got = spark.createDataFrame([(r,) for r in rows], "t string").select(text.description_section(F.col("t")).alias("s")).collect()
    assert [(r.s.found, r.s.content, r.s.rest) for r in got] == [(True, "what it does", "intro\n# Next\nrest"), (True, "all", ""), (False, "", "no heading"), (False, "", ""), (False, "", "a\n\nb")]


def test_hashes_against_hashlib(spark):
    import hashlib

    keys = ["a", "b/c", "ünï", "x" * 50]
    pool, split = hashing.pool_and_split(F.col("k"))
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = df.select("k", hashing.sha1_mod(F.col("k")).alias("m"), hashing.digest_mod(F.lit(97), F.lit("s"), F.col("k")).alias("d"), hashing.hash_parts(F.col("k"), F.lit("z")).alias("p"), pool.alias("pool"), split.alias("split")).collect()
    for r in got:
        h = lambda s: int(hashlib.sha1(s.encode()).hexdigest(), 16)
        assert r.m == h(r.k) % 1_000_000
        assert r.d == int(hashlib.sha1(f"s|{r.k}".encode()).hexdigest()[:16], 16) % 97
        assert r.p == hashlib.sha1(r.k.encode() + b"\0z\0").hexdigest()
        hidden = (h(f"20260501|{r.k}") % 1_000_000) / 1e6 < 0.5
        assert (r.pool, r.split == "unseen") == ("unseen" if hidden else "cpt", hidden)
