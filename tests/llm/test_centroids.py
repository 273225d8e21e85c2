import hashlib
import math
import random

import duckdb
import pytest

from reelframe.llm import centroids
from reelframe.llm.queries import LLM_ORACLES, LLM_QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, distance string, embeddings int"


def brute(rows, components, clusters=8, rounds=10):
    """(vec_id, vector, cluster, distance) and the final centroids, by every distance."""
    kept = []
    for number, row in rows:
        if row is not None and len(row) == components and all(x is not None and math.isfinite(x) for x in row):
            kept.append((number, [1024 * int(x) if abs(x) > 2**60 else math.floor(1024 * x) for x in row]))
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    middles = [row for _, row in first[:clusters]]

    def nearest(row):
        return min((sum((a - b) ** 2 for a, b in zip(row, c, strict=True)), k) for k, c in enumerate(middles))

    for _ in range(rounds):
        groups = {}
        for _, row in kept:
            groups.setdefault(nearest(row)[1], []).append(row)
        middles = [
            [sum(xs) // len(groups[k]) for xs in zip(*groups[k], strict=True)] if k in groups else c for k, c in enumerate(middles)
        ]
    return [(number, nearest(row)[1], nearest(row)[0]) for number, row in kept], middles


def compare(spark, rows, components):
    frame = spark.createDataFrame([(n, row, 0, "c", "d", 1) for n, row in rows], SCHEMA).repartition(3)
    fitted = centroids.fit(frame, components=components)
    found = centroids.cluster(frame, fitted, components).collect()
    wanted, middles = brute(rows, components)
    assert fitted == middles
    whole = {}
    for _, cluster, distance in wanted:
        whole[cluster] = whole.get(cluster, 0) + distance
    fits = lambda d: d if d < 2**63 else None

    def order(row):
        return (row[0] is None, row[0] or 0, row[1], row[2] is None, row[2] or 0)

    digests = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in middles]
    expected = [(n, c, fits(d), fits(whole[c]), fits(sum(whole.values())), digests[c]) for n, c, d in wanted]
    assert sorted(map(tuple, found), key=order) == sorted(expected, key=order)
    return found


def test_random_vectors_ties_and_repeats(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1.0, -0.0005, 0.0, 0.25, 1.0]) for _ in range(3)]) for i in range(200)]
    compare(spark, rows + rows[:20] + [(None, [0.5, 0.5, 0.5]), (7, [9.0, 9.0, 9.0])], 3)


def test_rows_that_do_not_count(spark):
    rows = [(1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [1.0, math.nan]), (6, [1.0, math.inf]), (7, [1.0, 2.0])]
    assert [row.vec_id for row in compare(spark, rows, 2)] == [7]
    frame = spark.createDataFrame([(n, row, 0, "c", "d", 1) for n, row in rows[:6]], SCHEMA)
    assert centroids.fit(frame, components=2) == []
    assert centroids.cluster(frame, [], 2).collect() == []


def test_numbers_beyond_64_bits(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-1, 1]) * 10.0 ** rng.randint(-3, 300) for _ in range(2)]) for i in range(40)]
    rows += [(100 + i, [rng.choice([-1, 1]) * rng.random() * 2**20 for _ in range(2)]) for i in range(40)]
    found = compare(spark, rows, 2)
    assert any(row.distance is None for row in found)
    assert any(row.distance is not None for row in found)


def test_hot_group(spark):
    """Many equal vectors leave a task as one sum."""
    rows = [(i, [1.0, 2.0]) for i in range(3000)] + [(5000 + i, [float(i), 0.0]) for i in range(50)]
    compare(spark, rows, 2)


def test_zero_lets_the_smaller_number_win():
    import numpy as np

    tournament = centroids.Tournament([[4, 0], [0, 0], [4, 0], [8, 0]])
    assert tournament.winners(np.array([[2, 5], [4, 0], [6, 0], [7, 1], [0, 9]])).tolist() == [0, 0, 0, 3, 1]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query_equals_sql_and_brute_force(spark, folder):
    found = LLM_QUERIES["op11_centroids"](spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    columns = ", ".join(found.columns)
    wanted = con.execute(f"SELECT {columns} FROM ({LLM_ORACLES['op11_centroids']})").fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(wanted)
    rows = con.execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    assert sorted((r.vec_id, r.cluster, r.distance) for r in found.collect()) == sorted(brute(rows, 64)[0])
