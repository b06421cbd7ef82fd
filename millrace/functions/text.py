"""Text columns: cleaning, clipping, tagged layers. All of it stays in Catalyst expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 characters that count as white space, with and without the line feed.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
SPACE_IN_LINE = r"[\t\x0b-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# Fixed value: what marks a clipped text.
SUFFIX = "\n\n[TRUNCATED]"
# Layer codes and their tags.
TAGS = {"M": "METADATA", "I": "INSTRUCTION", "R": "RESOURCE"}
LAYERS = {"stage1": ("M", "I"), "stage2": ("M", "I", "R")}


def let(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f(c)`` with ``c`` evaluated once, however often ``f`` mentions it. Catalyst doesn't share sub-expressions that stand
    in branches or lambdas, so a chain of regular expressions would else run once per mention."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def rstrip(c: Column) -> Column:
    # A run of spaces is tried from its start only, so that long runs cost no squares.
    return F.regexp_replace(c, f"(?<!{SPACE}){SPACE}" + r"++\z", "")


def strip(c: Column) -> Column:
    return F.regexp_replace(rstrip(c), r"\A" + SPACE + "+", "")


def clean(c: Column) -> Column:
    """Null as empty; line feeds only; no NUL; blanks and tabs run together; no space at line ends or around; at most one
    blank line in a row."""
    t = F.coalesce(c, F.lit(""))
    t = F.translate(F.regexp_replace(t, "\r\n?", "\n"), "\x00", "")
    t = F.regexp_replace(F.regexp_replace(t, "[ \t]+", " "), f"(?<!{SPACE_IN_LINE}){SPACE_IN_LINE}++\n", "\n")
    return F.regexp_replace(strip(t), "\n{3,}", "\n\n")


def clip(c: Column, limit: Column | int) -> Column:
    """At most ``limit`` characters, the mark included; 0 or less is no limit. A limit below the mark's length gives
    the mark alone."""
    if isinstance(limit, int) and limit <= 0:
        return c
    most, n = (F.lit(limit) if isinstance(limit, int) else limit), len(SUFFIX)

    def cut(t: Column) -> Column:
        short = lambda h: F.when(F.length(h) + n > most, rstrip(F.substring(h, F.lit(1), F.greatest(F.lit(0), most - n)))).otherwise(h)
        return F.when((most <= 0) | (F.length(t) <= most), t).otherwise(F.concat(let(rstrip(F.substring(t, F.lit(1), most)), short), F.lit(SUFFIX)))

    return let(c, cut)


def is_clipped(c: Column, limit: Column | int) -> Column:
    limit = F.lit(limit) if isinstance(limit, int) else limit
    return (limit > 0) & (F.length(c) > limit)


def tokens(c: Column) -> Column:
    """Estimate: a token for each four characters begun."""
    return F.floor((F.length(c) + 3) / 4).cast("bigint")


def headed(c: Column, head: str) -> Column:
    """A non-empty text after its head; an empty one stays empty."""
    return let(c, lambda t: F.when(t == "", "").otherwise(F.concat(F.lit(head), t)))


def wrap(c: Column, layer: str) -> Column:
    tag = TAGS[layer]
    return let(c, lambda t: F.when(t == "", "").otherwise(F.concat(F.lit(f"<{tag}>\n"), t, F.lit(f"\n</{tag}>"))))


def inner(c: Column, layer: str) -> Column:
    """What a whole tagged block holds; a text that is no such block is returned as it is."""
    tag = TAGS[layer]
    p = rf"(?s)\A<{tag}>\n(.*)\n</{tag}>\z"
    return let(c, lambda t: F.when(t.rlike(p), F.regexp_extract(t, p, 1)).otherwise(t))


def layer_of(c: Column, layer: str) -> Column:
    """The first block of a layer inside a composed text, up to the first closing tag; empty if there is none."""
    tag = TAGS[layer]
    return F.coalesce(F.regexp_extract(c, rf"(?s)<{tag}>\n(.*?)\n</{tag}>", 1), F.lit(""))


def join_parts(*parts: Column, sep: str = "\n") -> Column:
    """Non-empty parts in a row."""
    return F.array_join(F.filter(F.array(*parts), lambda p: p != ""), sep)


def replace_layer(c: Column, stage: str, layer: str, new: Column) -> Column:
    """A composed text with one layer's content replaced."""
    return join_parts(*(wrap(new if x == layer else layer_of(c, x), x) for x in LAYERS[stage]))


def description_section(c: Column) -> Column:
    """Struct ``(found, heading, content, rest)`` of the first heading that reads "description": its text up to the next
    heading, and the document without it."""
    head = r"(?imdU)^(#+)\s+(description)\s*$"
    at = F.regexp_instr(c, F.lit(head))
    mark = F.regexp_extract(c, head, 0)
    after = F.substring(c, at + F.length(mark), F.length(c))
    end = F.regexp_instr(after, F.lit(r"(?mdU)^#+\s+\S"))
    body = F.when(end > 0, F.substring(after, F.lit(1), end - 1)).otherwise(after)
    left = F.concat(F.substring(c, F.lit(1), at - 1), F.when(end > 0, F.substring(after, end, F.length(c))).otherwise(F.lit("")))
    found = at > 0
    return F.struct(
        found.alias("found"),
        F.when(found, F.regexp_extract(c, head, 2)).otherwise("").alias("heading"),
        F.when(found, strip(body)).otherwise("").alias("content"),
        strip(F.regexp_replace(F.when(found, left).otherwise(c), "\n{3,}", "\n\n")).alias("rest"),
    )
