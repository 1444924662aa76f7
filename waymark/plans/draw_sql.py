"""The draws of ``functions.draws`` as SQL text, for the oracles."""

from __future__ import annotations

from ..functions.draws import DIGITS, PER_HASH


def draw_sql(keys: list[str], seed: int, stream: int = 0) -> str:
    parts = ", ".join(f"coalesce((({key})::BIGINT)::VARCHAR, '')" for key in keys)
    text = f"concat_ws(':', '{seed}:{stream // PER_HASH}', {parts})"
    piece = f"substr(md5({text}), {1 + DIGITS * (stream % PER_HASH)}, {DIGITS})"
    return f"(('0x' || {piece})::BIGINT)"


def draw_int_sql(keys: list[str], lo: int, hi: int, seed: int, stream: int = 0) -> str:
    return f"((({draw_sql(keys, seed, stream)} * {hi - lo}) >> 32) + {lo})::INTEGER"


def draw_double_sql(keys: list[str], lo: float, hi: float, seed: int, stream: int = 0) -> str:
    fraction = f"({draw_sql(keys, seed, stream)})::DOUBLE / 4294967296::DOUBLE"
    return f"({fraction} * {hi - lo}::DOUBLE + {lo}::DOUBLE)"


def draw_digits_sql(keys: list[str], width: int, seed: int, stream: int = 0) -> str:
    return f"lpad(({draw_int_sql(keys, 0, 10**width, seed, stream)})::VARCHAR, {width}, '0')"


def draw_word_sql(
    keys: list[str], shortest: int, longest: int, suffix: str, seed: int, stream: int = 0
) -> str:
    letters = " || ".join(
        f"chr(((({draw_sql(keys, seed, stream)} * {26 ** (i + 1)}) >> 32) % 26 + 97)::INTEGER)"
        for i in range(longest)
    )
    length = draw_int_sql(keys, shortest, longest + 1, seed, stream + 1)
    return f"(substr({letters}, 1, {length}) || '{suffix}')"
