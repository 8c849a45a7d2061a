"""Plain Python versions that the operators are compared with, and DuckDB for those that have a SQL twin."""

from __future__ import annotations

import os
import re

import duckdb

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels", "conversations")
WORD = re.compile("[^\x20\x09-\x0d]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def duck(sql: str, sf_dir: str = SF):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path + ('/*.parquet' if os.path.isdir(path) else '')}'")
    return con.execute(sql)


def rows_of(sql: str, sf_dir: str = SF) -> list[tuple]:
    """Rows with columns in order of their names."""
    found = duck(sql, sf_dir)
    names = [d[0] for d in found.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(r[i] for i in order) for r in found.fetchall()), key=repr)


def collected(df) -> list[tuple]:
    names = sorted(df.columns)
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(_LOWER))


def shingle_set(text: str | None, size: int) -> frozenset:
    w = words(text)
    n = min(size, len(w))
    return frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if n else frozenset()


def near_groups(rows: list[tuple], size: int, percent: int = 80) -> list[int]:
    """A group number for each (id, text), by comparing all pairs."""
    sets = [shingle_set(t, size) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and group[i] != group[j] and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    old, new = group[i], group[j]
                    group = [new if g == old else g for g in group]
    return group
