"""The CRC-32 of bytes as a DuckDB expression, for SQL twins whose contract names it."""

from __future__ import annotations

_POLYNOMIAL = 0xEDB88320


def _of_bit(value: int) -> int:
    """What one bit of the low byte adds to the sum once that byte is shifted out."""
    for _ in range(8):
        value = (value >> 1) ^ (_POLYNOMIAL * (value & 1))
    return value


def crc32_sql(text: str) -> str:
    """SQL of the unsigned CRC-32 of the UTF-8 bytes of the expression ``text``.

    The sum is linear in the bits of a byte, so a step needs eight constants and no table.
    """
    step = "a >> 8"
    for bit in range(8):
        step = f"xor({step}, ((xor(a, b) >> {bit}) & 1) * {_of_bit(1 << bit)})"
    values = (
        f"list_transform(regexp_extract_all(hex(encode({text})), '..'), "
        "lambda z: CAST('0x' || z AS BIGINT))"
    )
    full = "CAST(4294967295 AS BIGINT)"
    return f"xor(list_reduce(list_prepend({full}, {values}), lambda a, b: {step}), {full})"
