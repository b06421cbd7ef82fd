"""Deterministic hashes, splits and ranks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO32 = 1 << 32


def hex_long(c: Column, at: int, n: int = 8) -> Column:
    """``n`` hexadecimal digits from place ``at`` (1-based) as a number."""
    return F.conv(F.substring(c, at, n), 16, 10).cast("bigint")


def sha1_mod(c: Column, modulus: int = 1_000_000) -> Column:
    """The whole SHA-1 of a text modulo ``modulus``, by Horner's rule over five 32-bit chunks."""
    h, shift = F.sha1(c), TWO32 % modulus
    acc = F.lit(0).cast("bigint")
    for i in range(5):
        acc = (acc * shift + hex_long(h, 1 + 8 * i)) % modulus
    return acc


def pool_and_split(key: Column, pool_seed: int = 20260501, split_seed: int = 20260502, unseen: float = 0.5, train: float = 0.8, val: float = 0.1) -> tuple[Column, Column]:
    """Pool (cpt or unseen) and split of a key, the same in every stage; the two draws are independent."""
    draw = lambda seed: sha1_mod(F.concat(F.lit(f"{seed}|"), key)) / 1_000_000
    hidden, p = draw(pool_seed) < unseen, draw(split_seed)
    split = F.when(hidden, "unseen").when(p < train, "train").when(p < train + val, "val").otherwise("test")
    return F.when(hidden, "unseen").otherwise("cpt"), split


def legacy_split(key: Column, seed: int, train: float, val: float) -> Column:
    p = hex_long(F.sha1(F.concat(F.lit(f"{seed}:"), key)), 1) / float(0xFFFFFFFF)
    return F.when(p < train, "train").when(p < train + val, "val").otherwise("test")


def digest_halves(*parts: Column) -> tuple[Column, Column]:
    """Upper and lower 32 bits of the first 64 bits of the SHA-1 of parts joined by ``|`` (unsigned, so kept apart)."""
    h = F.sha1(F.concat_ws("|", *parts))
    return hex_long(h, 1), hex_long(h, 9)


def digest_mod(modulus: Column, *parts: Column) -> Column:
    """The unsigned 64-bit digest modulo a positive column."""
    hi, lo = digest_halves(*parts)
    return ((hi % modulus) * (F.lit(TWO32) % modulus) + lo) % modulus


def hash_parts(*parts: Column) -> Column:
    """SHA-1 over parts that each end in a NUL, so that no two lists of parts run together."""
    return F.sha1(F.concat(*(x for p in parts for x in (p, F.lit("\x00")))))


def rank_key(tag: str, key: Column) -> Column:
    """Sorts like a shuffle that depends on the tag and the key alone."""
    return F.sha1(F.concat(F.lit(f"{tag}|"), key))
