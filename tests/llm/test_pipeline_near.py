"""The near dedup stage of the pipeline links from a similarity of 0.8 on."""

from corpus_pipeline import one_of_each
from tests.llm.brute import near_components, shingles


def planted():
    """Pairs of which the second has 11 to 20 of 200 words changed in one run: similarities from 0.78 to 0.86."""
    rows = []
    for pair in range(70):
        words = [f"p{pair}w{i}" for i in range(200)]
        start = 40 + pair
        changed = [f"c{i}" if start <= i < start + 11 + pair % 10 else w for i, w in enumerate(words)]
        rows += [(2 * pair, " ".join(words)), (2 * pair + 1, " ".join(changed))]
    return rows


def similarity(x, y):
    x, y = shingles(x), shingles(y)
    return len(x & y) / len(x | y)


def test_pairs_between_80_and_85(spark):
    rows = planted()
    found = [similarity(rows[i][1], rows[i + 1][1]) for i in range(0, len(rows), 2)]
    assert sum(0.8 <= x < 0.85 for x in found) > 20 and min(found) < 0.8 and max(found) >= 0.85
    want = near_components(rows, percent=80)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = sorted(r["doc_id"] for r in one_of_each(spark, docs, None).collect())
    assert kept == sorted(i for i in want if want[i][1] == i)
    assert len(kept) < len(near_components(rows)) - 20
