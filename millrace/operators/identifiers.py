"""Substituting outside identifiers (packages, flags, variables) in a layer: all places, a choice of them, the splice.

Places come from patterns; their offsets follow from the pieces between the matches, so everything stays in Catalyst. The
patterns see Unicode letters. Overlapping places give way to the earlier one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import LAYERS, layer_of, let, replace_layer, tokens
from millrace.operators.variants import MAX_TOKENS, T3B, row

REGISTRY_VERSION = 2
# Curated substitutes by registry.
PIP = {
    "pandas": "pandasx", "numpy": "numpyz", "requests": "requestz", "scipy": "scipyx", "scikit-learn": "scikit-learn-x", "sklearn": "sklearnx", "torch": "torchx", "tensorflow": "tensorflox",
    "transformers": "transformerx", "pyarrow": "pyarrowx", "matplotlib": "matplotlibx", "beautifulsoup4": "beautifulsoup5", "lxml": "lxml-pro", "pillow": "pillowx", "openpyxl": "openpyxl-x", "click": "clickx",
    "tqdm": "tqdmx", "pyyaml": "pyyaml-pro", "fastapi": "fastapix", "uvicorn": "uvicornx", "pydantic": "pydanticx", "openai": "openaix", "anthropic": "anthropicx", "boto3": "boto4", "redis": "redisx",
    "psycopg2": "psycopg3-fork", "sqlalchemy": "sqlalchemyx",
}
NPM = {
    "lodash": "lodash-extra", "chalk": "chalkx", "axios": "axios-pro", "react": "react-fast", "react-dom": "react-dom-fast", "vue": "vuex-core", "express": "expressx", "next": "nextjs-pro", "webpack": "webpack5-fork",
    "typescript": "typescript-pro", "eslint": "eslint-extra", "prettier": "prettierx-fmt", "@types/node": "@types/node-pro", "@nx/react": "@nx/react-codeshift", "@nx/devkit": "@nx/devkit-pro",
    "@angular/core": "@angular/core-pro", "uuid": "uuid-pro",
}
FLAGS = {"--force": "--force-strict", "--force-with-lease": "--safety-lease", "--quiet": "--ultra-quiet", "--verbose": "--ultra-verbose", "--dry-run": "--dry-strict", "--no-cache": "--zero-cache", "--recursive": "--deep-recursive"}
VARIABLES = {
    "OPENAI_API_KEY": "OPENAI_SECRET_KEY", "ANTHROPIC_API_KEY": "ANTHROPIC_SECRET_KEY", "AWS_ACCESS_KEY_ID": "AWS_ACCESS_TOKEN", "AWS_SECRET_ACCESS_KEY": "AWS_PRIVATE_TOKEN", "GITHUB_TOKEN": "GITHUB_ACCESS_TOKEN",
    "HF_TOKEN": "HF_API_KEY", "DATABASE_URL": "DB_CONNECTION_URL", "REDIS_URL": "REDIS_CONNECTION",
}
# Endings of made-up names, and standard modules that are never touched.
ENDINGS = ["-x", "-pro", "z", "-plus", "-ng", "-lite", "2"]
STANDARD = (
    "os", "sys", "re", "json", "math", "time", "datetime", "logging", "argparse", "pathlib", "hashlib", "random", "collections", "typing",
    "subprocess", "shutil", "io", "csv", "uuid", "tempfile", "functools", "itertools", "importlib", "warnings", "traceback", "string", "copy",
    "pickle", "base64", "urllib", "asyncio", "threading", "multiprocessing", "queue", "socket", "struct", "enum", "abc", "contextlib", "dataclasses",
    "ast", "inspect", "types", "operator", "weakref", "glob", "platform", "signal", "select", "errno", "stat", "fcntl", "gc", "atexit", "secrets",
    "hmac", "zlib", "gzip", "bz2", "lzma", "zipfile", "tarfile", "configparser", "decimal", "fractions", "statistics", "textwrap", "unicodedata",
    "html", "xml", "http", "email",
)
# The patterns of places.
IMPORT = r"^(\s*)(import|from)\s+([\w.]+)"
DEPENDENCY = r"\"((?:@[\w-]+/)?[\w.-]+)\"\s*:\s*\"[^\"]+\""
PIN = r"^([\w.-]+)\s*(==|>=|<=|~=)\s*([\w.\-+]+)"
REQUIRE = r"require\s*\(\s*['\"]([^'\"]+)['\"]\s*\)"
NPM_COMMAND = r"\b(npm|yarn|pnpm)\s+(install|add)\s+([@\w./-]+)"
PIP_COMMAND = r"\bpip\s+install\s+([\w.\-+]+)"
FLAG = r"--[a-z][\w-]+"
VARIABLE = r"\b([A-Z][A-Z0-9_]{4,})\b"


def _map(d: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for kv in d.items() for x in kv))


def made_up(name: Column, kind: str) -> Column:
    """A name with an ending that depends on kind and name alone."""
    byte = F.conv(F.substring(F.sha1(F.concat(F.lit(f"{kind}|"), name)), 1, 2), 16, 10).cast("int")
    return F.concat(name, F.element_at(F.array(*map(F.lit, ENDINGS)), byte % len(ENDINGS) + 1))


def looks_like_package(name: Column) -> Column:
    return name.rlike(r"^[a-z][a-z0-9_-]{2,}\z") & ~name.isin(*STANDARD)


def places(text: Column, pattern: str, lines: bool = False, groups: tuple[int, ...] = ()) -> Column:
    """All matches as ``array<struct<start, end, g0, g1...>>`` with 0-based offsets; no pattern may match emptily."""
    p = ("(?mdU)" if lines else "(?U)") + pattern
    names = ["g0", *(f"g{k + 1}" for k in range(len(groups)))]
    found = [F.regexp_extract_all(text, F.lit(p), F.lit(g)) for g in (0, *groups)]
    # Zipped, so that each pattern runs once per text and not once per place.
    rows = F.arrays_zip(F.split(text, p, -1).alias("between"), *(f.alias(n) for f, n in zip(found, names)))
    kind = "array<struct<start:int,end:int," + ",".join(f"{n}:string" for n in names) + ">>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

    def step(a: Column, x: Column) -> Column:
        start = a["at"] + F.length(x["between"])
        end = start + F.length(x["g0"])
        one = F.struct(start.alias("start"), end.alias("end"), *(x[n].alias(n) for n in names))
        return F.when(x["g0"].isNull(), a).otherwise(F.struct(end.alias("at"), F.concat(a["out"], F.array(one)).alias("out")))

    return F.coalesce(F.aggregate(rows, zero, step)["out"], F.array().cast(kind))


_HIT = "array<struct<start:int,end:int,repl:string,kind:string>>"


def _hits(found: Column, make) -> Column:
    """``make(x)`` gives (replacement, kind) columns; a null kind drops the place."""
    def one(x: Column) -> Column:
        repl, kind = make(x)
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), repl.alias("repl"), kind.alias("kind"))

    return F.filter(F.transform(found, one), lambda h: h["kind"].isNotNull())


def _choose(key: Column, table: dict[str, str], kind: str, package: Column, name: Column) -> tuple[Column, Column]:
    known = F.element_at(_map(table), key)
    ok = looks_like_package(package)
    return F.coalesce(known, F.when(ok, made_up(name, kind))), F.when(known.isNotNull(), kind).when(ok, f"{kind}_generic")


def _replace_first(whole: Column, old: Column, new: Column) -> Column:
    at = F.instr(whole, old)
    return F.concat(F.substring(whole, F.lit(1), at - 1), new, F.substring(whole, at + F.length(old), F.length(whole)))


def find_places(text: Column) -> Column:
    """All substitutable places by (start, end), overlaps removed, as ``array<struct<start, end, repl, kind>>``."""
    bare = lambda key: F.when(key.startswith("@"), F.element_at(F.split(F.regexp_replace(key, "^@+", ""), "/"), -1)).otherwise(key)

    def imports(x: Column):
        top = F.lower(F.element_at(F.split(x["g3"], r"\."), 1))
        new, kind = _choose(top, PIP, "py_import", top, top)
        return F.concat(x["g1"], x["g2"], F.lit(" "), new, F.substring(x["g3"], F.length(top) + 1, F.length(x["g3"]))), kind

    def pins(x: Column):
        key = F.lower(x["g1"])
        new, kind = _choose(key, PIP, "pip_pin", key, key)
        return F.concat(new, x["g2"], x["g3"]), kind

    def dependencies(x: Column):
        key = F.lower(x["g1"])
        new, kind = _choose(key, NPM, "npm_dep", bare(key), x["g1"])
        quote = lambda s: F.concat(F.lit('"'), s, F.lit('"'))
        return _replace_first(x["g0"], quote(x["g1"]), quote(new)), kind

    def requires(x: Column):
        key = F.lower(x["g1"])
        new, kind = _choose(key, NPM, "js_require", bare(key), x["g1"])
        return _replace_first(x["g0"], x["g1"], new), kind

    def npm(x: Column):
        key = F.lower(x["g3"])
        new, kind = _choose(key, NPM, "npm_cmd", bare(key), x["g3"])
        return F.concat_ws(" ", x["g1"], x["g2"], new), kind

    def pip(x: Column):
        key = F.lower(x["g1"])
        new, kind = _choose(key, PIP, "pip_cmd", key, key)
        return F.concat(F.lit("pip install "), new), kind

    def flags(x: Column):
        known = F.element_at(_map(FLAGS), x["g0"])
        return F.coalesce(known, made_up(x["g0"], "cli_flag")), F.when(known.isNotNull(), "cli_flag").otherwise("cli_flag_generic")

    def variables(x: Column):
        known = F.element_at(_map(VARIABLES), x["g1"])
        return known, F.when(known.isNotNull(), "env_var")

    found = [
        (places(text, IMPORT, True, (1, 2, 3)), imports), (places(text, PIN, True, (1, 2, 3)), pins), (places(text, DEPENDENCY, False, (1,)), dependencies), (places(text, REQUIRE, False, (1,)), requires),
        (places(text, NPM_COMMAND, False, (1, 2, 3)), npm), (places(text, PIP_COMMAND, False, (1,)), pip), (places(text, FLAG), flags), (places(text, VARIABLE, False, (1,)), variables),
    ]
    every = F.array_sort(F.concat(*(_hits(p, make) for p, make in found)))
    zero = F.struct(F.lit(-1).alias("end"), F.array().cast(_HIT).alias("out"))
    step = lambda a, h: F.when(h["start"] >= a["end"], F.struct(h["end"].alias("end"), F.concat(a["out"], F.array(h)).alias("out"))).otherwise(a)
    return F.aggregate(every, zero, step)["out"]


def choose(hits: Column, k: int, *tag: Column) -> Column:
    """At most ``k`` places by hash rank, in text order; independent of partitions."""
    key = lambda h: F.sha1(F.concat_ws("|", *tag, h["start"].cast("string")))
    ranked = F.slice(F.array_sort(F.transform(hits, lambda h: F.struct(key(h).alias("r"), h.alias("h")))), 1, k)
    return F.array_sort(F.transform(ranked, lambda x: x["h"]))


def splice(text: Column, hits: Column) -> Column:
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    step = lambda a, h: F.struct(h["end"].alias("at"), F.concat(a["out"], F.substring(text, a["at"] + 1, h["start"] - a["at"]), h["repl"]).alias("out"))
    return F.aggregate(hits, zero, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))


def layer_rows(rows: DataFrame, layers: dict[str, tuple[str, ...]] = T3B, empty: bool = False) -> DataFrame:
    """A row per positive and layer with content, or with ``empty`` per layer: adds ``layer`` and ``inner``."""
    def of(stage: str) -> Column:
        return F.array(*(F.struct(F.lit(x).alias("layer"), layer_of(F.col("text"), x).alias("inner")) for x in layers[stage]))

    out = rows.where(F.col("stage").isin(*layers)).withColumn("x", F.explode(F.when(F.col("stage") == "stage1", of("stage1")).otherwise(of("stage2"))))
    out = out.select(*rows.columns, "x.layer", "x.inner")
    return out if empty else out.where(F.trim("inner") != "")


def with_layer(new: Column) -> Column:
    """The row's composed text with its ``layer`` replaced."""
    out = F.lit(None).cast("string")
    for s, ls in LAYERS.items():
        for x in ls:
            out = F.when((F.col("stage") == s) & (F.col("layer") == x), replace_layer(F.col("text"), s, x, new)).otherwise(out)
    return out


# What may become of a layer.
EMITTED, EMPTY, NO_HIT, OVER = "emitted", "empty_layer", "no_hit", "over_budget"


def attempts(positives: DataFrame, k: int = 3, tag: str = "t3c") -> DataFrame:
    """A row per positive (``anchor_skill_id, text, pool, split, stage``) and layer: the text with up to ``k`` identifiers replaced, and
    its ``outcome``: emitted, empty_layer, no_hit (no identifier), over_budget."""
    rows = layer_rows(positives.select("anchor_skill_id", "text", "pool", "split", "stage"), empty=True)
    limit = F.when(F.col("stage") == "stage1", MAX_TOKENS["stage1"]).otherwise(MAX_TOKENS["stage2"])

    def made(c: Column) -> Column:
        return F.struct(F.when(F.size(c) > 0, let(splice(F.col("inner"), c), with_layer)).alias("text"), F.size(c).alias("n"), F.array_join(F.transform(c, lambda h: h["kind"]), ",").alias("kinds"))

    # One generator instead of columns and filters: a filter would be pushed below and find all places again.
    new = let(find_places(F.col("inner")), lambda h: let(choose(h, k, F.lit(tag), F.col("anchor_skill_id"), F.col("layer")), made))
    rows = rows.select("anchor_skill_id", "pool", "split", "stage", "layer", (F.trim("inner") == "").alias("_empty"), F.explode(F.array(new)).alias("x"))
    outcome = F.when(F.col("_empty"), EMPTY).when(F.col("x.n") == 0, NO_HIT).when(tokens(F.col("x.text")) > limit, OVER).otherwise(EMITTED)
    sub = F.concat(F.lit("layer="), F.col("layer"), F.lit(f"|method=rule|registry_v={REGISTRY_VERSION}|k="), F.col("x.n").cast("string"), F.lit("|kinds="), F.col("x.kinds"))
    return rows.select("anchor_skill_id", "pool", "split", "stage", "layer", F.col("x.text").alias("text"), sub.alias("sub"), outcome.alias("outcome"))


def emitted(tried: DataFrame, label: str = "T3c") -> DataFrame:
    """Variant rows of the attempts that gave one."""
    rows = tried.where(F.col("outcome") == EMITTED)
    return rows.select(*row(label, F.col("sub"), F.col("layer"), F.array("anchor_skill_id"), F.col("text"), "anchor_skill_id"))


def outcomes(tried: DataFrame) -> DataFrame:
    """Number of layers by stage, split, layer and outcome."""
    return tried.groupBy("stage", "split", "layer", "outcome").agg(F.count(F.lit(1)).alias("n_layers"))


def outcome_counts(tried: DataFrame) -> list[dict]:
    return [r.asDict() for r in outcomes(tried).orderBy("stage", "split", "layer", "outcome").collect()]  # a row per code


def substituted(positives: DataFrame, k: int = 3, tag: str = "t3c") -> DataFrame:
    """T3c: positives with up to ``k`` identifiers replaced per layer. Layers without a place and results over the budget are left out."""
    return emitted(attempts(positives, k, tag))
