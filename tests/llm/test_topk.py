import numpy as np
import pytest

from fareflow.llm.topk import Lists, Settings, top_k

SMALL_CELLS = Settings(k=5, every=3, queries=7, candidates=11, step=2)


def brute(rows, settings):
    """(query_id, rank) -> (vec_id, score); rows: id -> whole numbers."""
    out = {}
    for q, x in rows.items():
        if q % settings.every == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in rows.items() if i != q)
            out |= {(q, k + 1): (i, -s) for k, (s, i) in enumerate(scores[: settings.k])}
    return out


def found(df):
    return {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in df.collect()}


@pytest.mark.parametrize("kind", ["random", "ties", "same"])
def test_against_brute_force(spark, kind):
    random = np.random.RandomState(4)
    vectors = {
        "random": random.randn(90, 8), "ties": random.randint(-2, 3, (90, 3)) / 64, "same": np.ones((90, 4)),
    }[kind]
    rows = [(i - 20, [float(x) for x in v]) for i, v in enumerate(vectors)]
    whole = {i: [int(np.floor(64 * x)) for x in v] for i, v in rows}
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(top_k(table, SMALL_CELLS)) == brute(whole, SMALL_CELLS)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (3, [0.0, 0.0]), (6, []), (1, [1.0]), (2, None), (None, [1.0]),
        (4, [nan, 1.0]), (5, [1.0, inf]), (7, [None, 1.0]), (9, [-1.0, 1e200]), (12, [2.0**40, -(2.0**40)]),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS rank", "2 AS score")
    got = found(top_k(table, SMALL_CELLS))
    assert {q for q, _ in got} == {0, 3, 6, 9, 12}
    assert {i for i, _ in got.values()} == {0, 1, 3, 6, 9, 12}
    assert got[(3, 1)] == (0, 0) and got[(0, 1)] == (9, 2**63 - 1)
    assert got[(12, 1)] == (1, 64 * 64 * 2**40) and got[(12, 5)] == (9, -(2**63))
    assert top_k(table.limit(0)).count() == 0
    assert top_k(table.filter("vec_id = 0")).count() == 0


def test_stops_before_the_end_of_the_lists():
    """One candidate far ahead in every dimension: the bound falls below it after the first step."""
    values = np.concatenate([np.full((3, 4), 100.0), np.tile(np.arange(997.0)[:, None] % 50, (1, 4))])
    lists = Lists(np.arange(1000), values)
    ids, scores = lists.best(-1, np.ones(4), Settings(k=3, step=2))
    assert ids.tolist() == [0, 1, 2] and scores.tolist() == [400.0] * 3
