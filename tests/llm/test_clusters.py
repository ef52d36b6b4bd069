"""Sharded Lloyd against a plain one, with odd vectors, ties and small tables."""

from hashlib import sha256

import duckdb
import numpy as np
import pytest

from marginloom.llm.queries import ORACLES, op12_sharded_lloyd
from marginloom.llm.sharded_lloyd import lloyd


def plain_lloyd(rows, dims, k, rounds, scale=1024):
    """Rows of (id, vector); gives sorted (id, cluster, distance) and the centroids, in Python's integers."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, [int(np.floor(scale * float(x))) for x in v], [float(x) for x in v]))
    drawn = sorted(kept, key=lambda r: (sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[2]))
    centroids = [list(v) for _, v, _ in drawn[:k]]

    def assign():
        out = []
        for i, v, _ in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            out.append((i, d.index(min(d)), min(d)))
        return out

    for _ in range(rounds if kept else 0):
        numbers = [c for _, c, _ in assign()]
        for c in range(len(centroids)):
            own = [v for (_, v, _), n in zip(kept, numbers, strict=True) if n == c]
            if own:
                centroids[c] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    return sorted(assign(), key=str) if kept else [], centroids


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, cluster int, ids string")


@pytest.mark.parametrize("width,tile_rows", [(2, 3), (5, 100), (1, 7)])
def test_lloyd(spark, width, tile_rows):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(i % 3, 1, 5)]) for i in range(80)]
    # ties, repeated rows and ids, a null id, vectors that don't count
    rows += [(7, rows[7][1]), (7, [0.0] * 5), (None, [1.0] * 5), (200, [-0.0005] * 5), (201, [0.0] * 5), (202, [0.0] * 5)]
    rows += [(300, None), (301, []), (302, [1.0] * 4), (303, [1.0] * 6), (304, [1.0, None, 1.0, 1.0, 1.0])]
    rows += [(305, [1.0, float("nan"), 1.0, 1.0, 1.0]), (306, [float("inf")] * 5), (307, [float("-inf")] * 5)]
    got, centroids = lloyd(table(spark, rows), dims=5, k=4, rounds=6, width=width, tile_rows=tile_rows)
    want, want_centroids = plain_lloyd(rows, 5, 4, 6)
    assert centroids.tolist() == want_centroids
    assert sorted([tuple(r) for r in got.collect()], key=str) == want


def test_empty_clusters_keep_their_centroids_and_few_vectors(spark):
    rows = [(i, [1.0, 2.0]) for i in range(6)]
    got, centroids = lloyd(table(spark, rows), dims=2, k=4, rounds=3, width=1)
    assert centroids.tolist() == [[1024, 2048]] * 4 and {r.cluster for r in got.collect()} == {0}
    got, centroids = lloyd(table(spark, rows[:2]), dims=2, k=4, rounds=3)
    assert len(centroids) == 2 and got.count() == 2
    for none in ([], [(1, None)]):
        got, centroids = lloyd(table(spark, none), dims=2, k=4)
        assert got.columns == ["vec_id", "cluster", "distance"] and got.count() == 0 and len(centroids) == 0


def test_too_large_components_stop(spark):
    with pytest.raises(Exception, match="too large"):
        lloyd(table(spark, [(1, [1e30, 0.0])]), dims=2)[0].count()


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    got = op12_sharded_lloyd(spark, folder)
    want = duck.execute(ORACLES["op12_sharded_lloyd"])
    columns = [d[0] for d in want.description]
    assert got.columns == columns
    assert sorted(tuple(r) for r in got.collect()) == sorted(want.fetchall())
