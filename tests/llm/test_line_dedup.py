import hashlib

import numpy as np

from fareflow.llm import line_dedup
from fareflow.llm.line_dedup import Filter, Settings, digests, drop_common_lines
from tests.llm.brute import documents, without_common_lines


def test_against_brute_force(spark):
    rows = documents()
    want = without_common_lines(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    # A filter of the least size lets nearly everything through; the result is the same.
    for settings in (Settings(), Settings(most_bits=8 * line_dedup.CHUNK, bits_per_line=1)):
        got = {r["doc_id"]: r for r in digests(docs, settings).collect()}
        assert set(got) == set(want)
        for i, (n, rest) in want.items():
            sha = hashlib.sha256("\n".join(rest).encode()).hexdigest()
            assert (got[i]["n_lines"], got[i]["n_dropped"], got[i]["kept_sha256"]) == (n, n - len(rest), sha)
    assert sum(n - len(rest) for n, rest in want.values()) > 50


def test_odd_rows(odd, none):
    out = drop_common_lines(odd)
    assert out.columns == odd.columns and out.dtypes == odd.dtypes
    rows = {r["doc_id"]: r for r in out.collect()}
    # Held by documents 1, 2 and 3, and kept in 3; the repeated row counts once and loses the same.
    assert rows[3]["text"].split("\n")[1] == "a line that is long enough to count"
    assert rows[1]["text"] == rows[2]["text"].replace("one TWO", "One two") and rows[1]["n_chars"] == len(rows[1]["text"])
    assert rows[4]["text"] is None and rows[5]["text"] == ""
    assert out.count() == odd.count() and digests(odd).count() == odd.count()
    assert drop_common_lines(none).count() == digests(none).count() == 0
    assert drop_common_lines(odd.drop("n_chars")).columns == odd.drop("n_chars").columns


def test_rows_without_id_are_one_document(spark):
    line = "a line of more than twenty characters"
    rows = [(None, line), (None, line), (1, line), (2, line + "\n" + line)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_lines"], r["n_dropped"]) for r in digests(docs).collect())
    assert got == [(0, 1, 1), (0, 1, 1), (1, 1, 1), (2, 2, 0)]
    assert digests(docs.filter("doc_id is null or doc_id < 2")).filter("n_dropped > 0").count() == 0


def test_filter_has_no_false_negatives():
    hashes = np.random.RandomState(1).randint(0, 2**63, 5000).astype(np.uint64)
    found = Filter(2**16)
    found.add(hashes)
    assert found.has(hashes).all()
    assert Filter(2**20).has(hashes).sum() == 0


def test_half_of_the_rows_without_id(spark):
    """Each such row carries the lines that it loses itself, not those of all of them."""
    shared = [f"shared line number {i} of many documents" for i in range(500)]
    rows = [(None, f"own text {i} of a row without an id\n{shared[i % 500]}") for i in range(2000)]
    rows += [(i, "\n".join(shared[j % 500] for j in range(i, i + 5))) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    lost = line_dedup.dropped_lines(docs)
    assert max(len(r["digests"]) for r in lost.filter(f"id = {line_dedup.NO_ID}").collect()) == 1
    got = digests(docs).groupBy("doc_id").agg({"n_dropped": "sum", "n_lines": "sum"}).filter("doc_id IS NULL").first()
    assert (got["sum(n_dropped)"], got["sum(n_lines)"]) == (2000, 4000)
    with_ids = {r["doc_id"]: r["n_dropped"] for r in digests(docs.filter("doc_id IS NOT NULL")).collect()}
    # The nameless document is the smallest, and every line is held by enough others without it.
    assert {r["doc_id"]: r["n_dropped"] for r in digests(docs).filter("doc_id IS NOT NULL").collect()} == with_ids
