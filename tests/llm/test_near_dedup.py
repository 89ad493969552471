import numpy as np
import pytest

from fareflow.llm.components import components
from fareflow.llm import near_dedup
from fareflow.llm.near_dedup import Settings, keep_one, least_matches, near_duplicates, prune, shared_counts
from fareflow.llm.shingles import MinHash, shingle_set
from tests.llm.brute import documents, near_components, shingles


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


# Cells of two members make every bucket many cells.
@pytest.mark.parametrize("settings", [Settings(), Settings(cell=2)])
def test_against_brute_force(spark, settings):
    rows = documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = near_components(rows)
    assert found(near_duplicates(docs, settings)) == want
    assert len({c for _, c in want.values()}) < len(want) - 50


def test_a_base_that_is_not_the_smallest(spark):
    """Copies of a text that are near to it, and not to each other, are linked through it."""
    base = [f"w{i}" for i in range(400)]
    rows = [(999, " ".join(base))]
    for i in range(40):
        copy = list(base)
        for j in range(6):
            copy[(i * 9 + j * 61) % 400] = f"x{i}y{j}"
        rows.append((i, " ".join(copy)))
    want = near_components(rows)
    assert {c for _, c in want.values()} == {0}
    assert found(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == want


def test_odd_rows(odd, none):
    out = near_duplicates(odd)
    assert out.count() == odd.count()
    rows = {(r["doc_id"], r["n_shingles"]): r for r in out.collect()}
    assert rows[(4, 0)]["component_id"] == 4 and rows[(4, 0)]["kept"] and rows[(6, 0)]["kept"]
    assert rows[(11, 1)]["component_id"] == 10 and not rows[(11, 1)]["kept"]
    assert rows[(8, 60_000 - 4 - (60_000 - 9973 - 4) + 1)]["component_id"] == 7
    assert rows[(None, 1)]["component_id"] is None and rows[(None, 1)]["kept"]
    kept = keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] or 0) for r in kept.collect())
    assert ids == [0, 0, 1, 3, 4, 5, 6, 7, 9, 10, 12]
    assert near_duplicates(none).count() == keep_one(none).count() == 0


def test_shingles_and_signatures():
    text = "The  the\tA a b c d e f the the a a b"
    assert len(shingle_set(text)) == len(shingles(text))
    minhash = MinHash(2000)
    x, y = (set_of(range(1000)), set_of(range(100, 1100)))
    a, b = (np.frombuffer(minhash.signature(s), "<u4") for s in (x, y))
    assert abs((a == b).mean() - 900 / 1100) < 0.04
    long = shingle_set(" ".join(map(str, range(20_000))))
    small = MinHash(8)
    parts = [np.frombuffer(small.signature(p), "<u4") for p in np.array_split(long, 7)]
    assert (np.frombuffer(small.signature(long), "<u4") == np.min(parts, axis=0)).all()


def set_of(numbers):
    return np.unique(np.concatenate([shingle_set(f"n{i}") for i in numbers]))


def test_pruning_rarely_drops_a_pair_at_the_threshold():
    settings = Settings()
    assert [n for n, _ in least_matches(settings)] == [25, 50, 75, 100, 125]
    random = np.random.RandomState(5)
    same = random.rand(20_000, settings.hashes) < 0.85
    left = np.zeros(same.shape, np.uint32)
    alive, matches = prune(left, np.where(same, 0, 1).astype(np.uint32), settings)
    assert len(alive) >= 19_998 and (matches == same[alive].sum(axis=1)).all()
    far = random.rand(20_000, settings.hashes) < 0.5
    assert len(prune(left, np.where(far, 0, 1).astype(np.uint32), settings)[0]) < 10


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 50), (50, 75), (75, 100), (200, 200), (7, 3)]
    edges += [(1000, 1000 + i) for i in range(1, 60)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 1 for i in range(1, 41)} | {100: 50, 50: 50, 75: 50} | {1000 + i: 1000 for i in range(60)}
    assert got == want


def test_shared_counts(monkeypatch):
    random = np.random.RandomState(3)
    sets = [np.unique(random.randint(0, 90, n)).astype(np.uint64) for n in (50, 1, 70, 0, 40)]
    want = [[len(set(x.tolist()) & set(y.tolist())) for y in sets] for x in sets]
    for columns in (8192, 7):
        monkeypatch.setattr(near_dedup, "COLUMNS", columns)
        got = shared_counts(sets)
        assert all(got[i][j] == want[i][j] for i in range(5) for j in range(5) if i != j)
    assert not shared_counts([np.array([1], np.uint64), np.array([2], np.uint64)]).any()
