"""Range queries with about equally many rows each; the database is a list of ids and DuckDB's SQL."""

import random

import duckdb
import pytest

from tillmark.sources import tables


def counter(ids, asked):
    def count(ranges, width):
        asked.append(len(ranges))
        out = {}
        for a, b in ranges:
            for i in ids:
                if a <= i <= b:
                    start = i - (i - a) % width
                    out[start] = out.get(start, 0) + 1
        return out

    return count


RND = random.Random(1)
SPREADS = {
    "even": list(range(10_000)),
    "gaps": [*range(4000), *range(10**9, 10**9 + 5000), *range(10**15, 10**15 + 1000)],
    "sparse": sorted({RND.randrange(-(2**62), 2**62) for _ in range(6000)}),
    "one far id": [*range(5000), 2**60],
    "clusters": [c * 10**12 + i for c in range(10) for i in range(600)],
    "one": [7], "two": [1, 2**62],
}


@pytest.mark.parametrize("name", SPREADS)
@pytest.mark.parametrize("parts", [1, 2, 16, 200])
def test_ranges_hold_equally_many_rows(name, parts):
    ids, asked = SPREADS[name], []
    cuts = tables.balanced_cuts(counter(ids, asked), min(ids), max(ids), parts)
    assert cuts == sorted(set(cuts)) and len(cuts) < parts
    edges = [float("-inf"), *cuts, float("inf")]
    sizes = [sum(a <= i < b for i in ids) for a, b in zip(edges, edges[1:])]
    assert sum(sizes) == len(ids) and max(sizes) <= 1.26 * len(ids) / parts + 1
    assert len(asked) <= 8


@pytest.mark.parametrize("name", SPREADS)
def test_queries_and_predicates_in_sql(name):
    ids = SPREADS[name]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (id BIGINT, day DATE)")
    con.executemany("INSERT INTO t VALUES (?, DATE '2024-01-01')", [[i] for i in [*ids[:500], None]])
    low, high = con.execute("SELECT min(id), max(id) FROM t").fetchone()

    def count(ranges, width):
        return dict(con.execute(tables.count_query("t", "id", ranges, width, "day > '2023-01-01'")).fetchall())

    cuts = tables.balanced_cuts(count, low, high, 8)
    found = [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in tables.range_predicates("id", cuts)]
    assert sum(found) == len(ids[:500]) + 1 and max(found) <= 1.26 * sum(found) / 8 + 2


def test_no_cut_is_one_query():
    assert tables.range_predicates("id", []) == ["id IS NULL OR id IS NOT NULL"]
    assert tables.range_predicates("id", [5]) == ["id < 5 OR id IS NULL", "id >= 5"]
