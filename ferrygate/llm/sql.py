"""Pieces of DuckDB statements that several operators share."""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, by the bits of its reversed polynomial."""
    by_bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, ignored: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda c, b: {by_bits}), 4294967295)"
