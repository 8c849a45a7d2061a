"""CRC-32 in SQL, for twins of queries whose contracts use it."""

#: CRC-32 of a list of bytes, from a table of remainders made of the polynomial.
CRC_SQL = """
  bits AS (SELECT list(r ORDER BY b) AS crc_table FROM (
    SELECT b, list_reduce([CAST(b AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda r, x: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END) AS r
    FROM range(256) t(b)))
"""


def crc_sql(byte_list: str) -> str:
    return (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {byte_list}), "
            f"lambda c, x: xor(c // 256, crc_table[xor(c, x) % 256 + 1])), 4294967295)")


def bytes_sql(text: str) -> str:
    """UTF-8 bytes of a text of code points up to U+00FF."""
    return (f"flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)] "
            f"ELSE [CAST(192 + ord(c) // 64 AS BIGINT), CAST(128 + ord(c) % 64 AS BIGINT)] END))")
