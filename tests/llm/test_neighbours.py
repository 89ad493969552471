import numpy as np
import pytest

from fareflow.llm import neighbours
from fareflow.llm.neighbours import BITS, Codes, Index, Settings, nearest, part_radii
from tests.conftest import SMALL

SMALL_CELLS = Settings(k=5, every=3, cell=16, queries=7)


def brute(rows, k, every):
    """(query_id, rank) -> (vec_id, distance)."""
    out = {}
    for q, x in rows.items():
        if q % every == 0:
            near = sorted((float(np.sqrt(((y - x) ** 2).sum())), i) for i, y in rows.items() if i != q)
            out |= {(q, r): (i, d) for r, (d, i) in enumerate(near[:k], 1)}
    return out


def got(df):
    return {(r.query_id, r.rank): (r.vec_id, r.score) for r in df.collect()}


def vectors(spark, values, first=-20):
    rows = {i + first: np.array(v, float) for i, v in enumerate(values)}
    table = spark.createDataFrame([(i, v.tolist()) for i, v in rows.items()], "vec_id long, embedding array<double>")
    return rows, table.repartition(4)


@pytest.mark.parametrize("kind", ["random", "copies", "line"])
def test_whole_radius_is_exact(spark, kind, monkeypatch):
    """With a radius of all bits nothing is left out: the rows are those of brute force, ties included."""
    random = np.random.RandomState(4)
    values = {
        "random": random.randn(90, 8), "copies": random.randint(-1, 2, (90, 3)) + 0.5, "line": np.arange(1, 91)[:, None],
    }[kind]
    monkeypatch.setattr(neighbours, "learned_radius", lambda *a: BITS)
    rows, table = vectors(spark, values)
    assert got(nearest(table, SMALL_CELLS)) == brute(rows, 5, 3)


def test_recall_against_brute_force(spark):
    random = np.random.RandomState(7)
    rows, table = vectors(spark, random.randn(12, 24)[random.randint(0, 12, 1500)] + 0.6 * random.randn(1500, 24))
    settings = Settings(every=20, cell=100, queries=30)
    found, want = got(nearest(table, settings)), brute(rows, 10, 20)
    assert found.keys() == want.keys()
    ids = lambda x: {(q, i) for (q, _), (i, _) in x.items()}
    assert len(ids(found) & ids(want)) >= 0.95 * len(want)
    for (q, _), (i, d) in found.items():
        assert d == pytest.approx(np.linalg.norm(rows[q] - rows[i]), rel=1e-12)


def test_recall_of_the_registered_query(spark):
    from fareflow.llm.queries import op13_neighbours

    table = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()}
    found, want = got(op13_neighbours(spark, SMALL)), brute(table, 10, 100)
    assert found.keys() == want.keys()
    assert len({(q, i) for (q, _), (i, _) in found.items()} & {(q, i) for (q, _), (i, _) in want.items()}) >= 0.9 * len(want)


@pytest.mark.parametrize("radius", [0, 3, 8, 13, 40, 64])
def test_every_code_within_the_radius_is_found_once(radius):
    """The parts together give the rows of a scan, each once, by probing and by looking through buckets."""
    random = np.random.RandomState(radius)
    base = random.randint(0, 2**63, 40).astype(np.uint64)
    flips = np.array([np.bitwise_or.reduce(np.uint64(1) << random.randint(0, 64, random.randint(1, 50)).astype(np.uint64)) for _ in range(3000)])
    codes = base[random.randint(0, 40, 3000)] ^ flips
    settings = Settings()
    radii = part_radii(radius, settings)
    for code in base[:10]:
        found = []
        for part, most in enumerate(radii):
            if most >= 0:
                cell = Index([[i] for i in range(3000)], np.zeros((3000, 1)), codes, part, settings)
                found += [cell.ids[i][0] for i in cell.within(code, radius, radii)]
        assert sorted(found) == np.flatnonzero(np.bitwise_count(codes ^ code) <= radius).tolist()


def test_a_query_with_few_rows_near_asks_again(spark):
    """Far queries find nothing within the learned radius and still get k rows."""
    random = np.random.RandomState(3)
    near = random.randn(1, 16) + 0.01 * random.randn(300, 16)
    rows, table = vectors(spark, np.concatenate([near, -50 * np.abs(random.randn(9, 16))]), first=0)
    found = got(nearest(table, Settings(every=100, k=10, sample=64, cell=64)))
    assert {q for q, _ in found} == {0, 100, 200, 300} and len(found) == 40


def test_copies_of_a_third_of_all_rows(spark):
    """Copies are one row of the index with the smallest ids; a query that is a copy finds the others."""
    values = np.concatenate([np.ones((200, 6)), np.random.RandomState(1).randn(400, 6)])
    rows, table = vectors(spark, values, first=0)
    found, want = got(nearest(table, Settings(every=50, cell=64))), brute(rows, 10, 50)
    for q in (0, 50, 100, 150):
        assert [found[q, r] for r in range(1, 11)] == [want[q, r] for r in range(1, 11)]
    index = neighbours.distinct_vectors(table.selectExpr("vec_id", "embedding AS vector"), 10).collect()
    assert len(index) == 401 and max(len(r.ids) for r in index) == 11


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (3, [0.0, 0.0]), (6, []), (1, [1.0]), (2, None), (None, [1.0]),
        (4, [nan, 1.0]), (5, [1.0, inf]), (7, [None, 1.0]), (9, [-1.0, 1e200]), (12, [1.0, 2.0]), (15, [1.0, 0.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    clash = table.selectExpr("*", "1 AS rank", "2 AS score", "3 AS code", "4 AS ids", "5 AS vector", "'x' AS query_id")
    found = got(nearest(clash, SMALL_CELLS))
    assert {q for q, _ in found} == {0, 9, 12, 15}
    assert {i for i, _ in found.values()} == {0, 1, 9, 12, 15}
    assert found[0, 1] == (12, 0.0) and found[0, 2] == (1, 2.0) and found[0, 3] == (15, 2.0)
    assert found[9, 1][1] == inf or found[9, 1][1] > 1e199
    assert nearest(clash.limit(0)).count() == 0
    assert nearest(clash.filter("vec_id = 0")).count() == 0
    assert nearest(clash).columns == ["query_id", "rank", "vec_id", "score"]


def test_codes_have_64_bits_whatever_the_width():
    random = np.random.RandomState(2)
    for width in (1, 5, 64, 100):
        sample = random.randn(200, width)
        codes = Codes.learn(sample, 5).of(sample)
        assert codes.dtype == np.uint64 and len(set(codes.tolist())) > 1
