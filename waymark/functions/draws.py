"""Reproducible pseudo-random values as functions of a row's key.

``rand(seed)`` depends on how rows are partitioned, so a re-run on another
cluster, or a lost task that is computed again over re-ordered input, may see
other values. These draws depend only on the key columns and the seed: they are
32-bit pieces of an MD5 of both, which any SQL engine can recompute.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PER_HASH = 4  # an MD5 has four pieces of 32 bits
DIGITS = 8


def _piece(keys: list[Column | str] | Column | str, seed: int, stream: int) -> Column:
    """Eight hexadecimal digits of the key's hash."""
    keys = keys if isinstance(keys, list) else [keys]
    parts = [(F.col(k) if isinstance(k, str) else k).cast("bigint").cast("string") for k in keys]
    text = F.concat_ws(":", F.lit(f"{seed}:{stream // PER_HASH}"), *[F.coalesce(p, F.lit("")) for p in parts])
    return F.substring(F.md5(text), 1 + DIGITS * (stream % PER_HASH), DIGITS)


def draw(keys: list[Column | str] | Column | str, seed: int, stream: int = 0) -> Column:
    """A bigint uniform in [0, 2**32); give each use of one key its own ``stream``.

    Keys are whole numbers; NULL counts as an empty text. Four streams in a row are
    pieces of one hash, which is computed once where a projection uses several.
    """
    return F.conv(_piece(keys, seed, stream), 16, 10).cast("bigint")


def draw_below(keys, seed: int, bound: int, stream: int = 0) -> Column:
    """Whether the draw is under ``bound``, from its digits: texts of one length order like numbers."""
    if bound >= 16**DIGITS:
        return F.lit(True)
    return _piece(keys, seed, stream) < F.lit(f"{bound:0{DIGITS}x}")


def draw_int(keys, lo: int, hi: int, seed: int, stream: int = 0) -> Column:
    """Whole number uniform in [lo, hi), for ranges below 2**31."""
    return (F.shiftright(draw(keys, seed, stream) * (hi - lo), 32) + lo).cast("int")


def draw_double(keys, lo: float, hi: float, seed: int, stream: int = 0) -> Column:
    """Double uniform in [lo, hi)."""
    return draw(keys, seed, stream) / F.lit(float(2**32)) * (hi - lo) + lo


def draw_digits(keys, width: int, seed: int, stream: int = 0) -> Column:
    """Text of ``width`` (at most 9) random digits, leading zeros kept."""
    return F.lpad(draw_int(keys, 0, 10**width, seed, stream).cast("string"), width, "0")


def draw_word(
    keys, shortest: int, longest: int, suffix: str, seed: int, stream: int = 0
) -> Column:
    """Random lower-case word with ``shortest`` to ``longest`` (at most 6) letters.

    The base-26 digits of one draw give the letters; ``stream + 1`` the length.
    """
    fraction = draw(keys, seed, stream)
    length = draw_int(keys, shortest, longest + 1, seed, stream + 1)
    letters = [
        F.char(F.shiftright(fraction * 26 ** (i + 1), 32) % 26 + ord("a"))
        for i in range(longest)
    ]
    always, maybe = letters[:shortest], enumerate(letters[shortest:], shortest)
    tail = [F.when(length > i, letter).otherwise("") for i, letter in maybe]
    return F.concat(*always, *tail, F.lit(suffix))
