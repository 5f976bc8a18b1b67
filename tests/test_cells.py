"""Nearest vectors from cells, held against a scan of all rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.operators import cells, vectors


def _made(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in rows], "id long, embedding array<float>")


def _clustered(n=3000, dims=16, groups=20, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dims))
    return [(i, centres[i % groups] + 0.25 * rng.normal(size=dims)) for i in range(n)]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rows = _clustered()
    # a third of all rows are one vector; some rows are near to nothing
    rows += [(10_000 + i, rows[0][1]) for i in range(1500)]
    rows += [(20_000, None), (20_001, [0.0] * 16), (20_002, [float("nan")] * 16)]
    df = _made(spark, rows).cache()
    return df, cells.build_cells(df, str(tmp_path_factory.mktemp("cells")), cells=40), dict(rows)


def _scan(rows, query, k):
    """The plain restatement: all similarities, rounded, ties by id."""
    q = np.asarray(query, dtype=np.float64)
    scored = []
    for i, v in rows.items():
        if v is None:
            continue
        v = np.asarray(v, dtype=np.float32).astype(np.float64)
        norm = np.sqrt((v * v).sum())
        if norm > 0:
            scored.append((-round(float(v @ q / norm / np.sqrt(q @ q)), 6), i))
    return [i for _, i in sorted(scored)[:k]]


def test_every_row_is_in_a_cell(index):
    df, built, rows = index
    assert built.rows.count() == len(rows) - 3 == int(built.sizes.sum())
    assert built.rows.select("id").distinct().count() == len(rows) - 3


def test_exact_search_equals_a_scan(index):
    _, built, rows = index
    for i in (0, 7, 123, 2999):
        query = [float(np.float32(x)) for x in rows[i]]
        found = [r["id"] for r in cells.search_cells(built, query, 10, probes=1, exact=True).collect()]
        assert found == _scan(rows, query, 10)


def test_only_opened_cells_are_read(index):
    _, built, rows = index
    found = cells.search_cells(built, [float(x) for x in rows[5]], 10, probes=3)
    plan = found._jdf.queryExecution().explainString(found.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [cell" in plan
    opened = {r["cell"] for r in built.rows.where(F.col("cell").isin(built.probed(cells._units(_series(rows[5]))[0], 10, 3))).select("cell").distinct().collect()}
    assert len(opened) <= 3 < len(built.sizes)


def _series(vector):
    import pandas as pd

    return pd.Series([np.asarray(vector)])


def test_more_cells_are_opened_until_k_rows_are_found(index):
    _, built, rows = index
    k = int(np.sort(built.sizes)[-1]) + 500
    assert cells.search_cells(built, [float(x) for x in rows[3]], k, probes=1).count() == k


def test_recall_of_many_queries(index):
    df, built, rows = index
    queries = df.where("id % 20 = 0").withColumnRenamed("id", "query")
    found = {}
    for r in cells.search_many(built, queries, 10, probes=6, block=256).collect():
        found.setdefault(r["query"], []).append((r["rank"], r["id"]))
    asked = [i for i, v in rows.items() if i % 20 == 0 and i != 20_000]
    assert set(found) == set(asked)
    assert all(len(f) == 10 for f in found.values())
    hit = sum(
        len({i for _, i in found[q]} & set(_scan(rows, [float(np.float32(x)) for x in rows[q]], 10))) for q in asked
    )
    assert hit / (10 * len(asked)) >= 0.9


def test_all_cells_opened_for_many_queries_equal_a_scan(index):
    df, built, rows = index
    queries = df.where("id in (0, 41, 10003, 2000)").withColumnRenamed("id", "query")
    got = cells.search_many(built, queries, 15, probes=len(built.sizes), block=200).orderBy("query", "rank").collect()
    for q in (0, 41, 10003, 2000):
        assert [r["id"] for r in got if r["query"] == q] == _scan(rows, [float(np.float32(x)) for x in rows[q]], 15)


def test_queries_without_direction_find_nothing(index):
    df, built, _ = index
    queries = df.where("id >= 20000").withColumnRenamed("id", "query")
    assert cells.search_many(built, queries, 5).count() == 0
    assert cells.search_cells(built, [0.0] * 16, 5).count() == 0


def test_empty_table(spark, tmp_path):
    built = cells.build_cells(_made(spark, []), str(tmp_path / "none"))
    assert cells.search_cells(built, [1.0] * 4, 3).count() == 0
    assert cells.search_many(built, _made(spark, [(1, [1.0, 2.0])]).withColumnRenamed("id", "query"), 3).count() == 0


def test_written_index_is_read_again(index, spark, tmp_path):
    df, _, rows = index
    path = str(tmp_path / "again")
    cells.build_cells(df.where("id < 200"), path, cells=4)
    again = cells.read_cells(spark, path)
    query = [float(np.float32(x)) for x in rows[9]]
    few = {i: v for i, v in rows.items() if i < 200}
    assert [r["id"] for r in cells.search_cells(again, query, 5, exact=True).collect()] == _scan(few, query, 5)
    exact = vectors.nearest(df.where("id < 200"), F.array(*[F.lit(x) for x in query]), 5)
    assert [r["id"] for r in exact.collect()] == _scan(few, query, 5)
