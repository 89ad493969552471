from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from fareflow.llm.quality import Limits, beta_prior, document_stats, host_verdicts, keep_good, measure, quality
from tests.llm.brute import LONG, blank_split


@settings(deadline=None)
@given(st.text(alphabet="ab \n\t\x1c #é", max_size=60))
def test_statistics(text):
    found = blank_split(text)
    windows = Counter(zip(found, found[1:], found[2:]))
    covered = {j for i in range(len(found) - 2) if windows[tuple(found[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if blank_split(x)]
    want = len(found), sum(map(len, found)), text.count("#"), len(lines) - len(set(lines)), len(lines), len(covered)
    assert document_stats(text) == want


def test_odd_rows(odd, none):
    rows = quality(odd).collect()
    assert len(rows) == odd.count()
    by_text = {r["doc_id"]: r for r in rows}
    assert by_text[4]["base_failed"] and by_text[4]["n_words"] == 0 and not by_text[4]["kept"]
    assert by_text[7]["n_words"] == 60_000 and by_text[7]["base_failed"]
    assert quality(none).count() == 0
    kept = keep_good(odd)
    assert kept.columns == odd.columns
    assert keep_good(none).count() == 0


def good(i):
    return " ".join(f"word{i}x{j}" for j in range(80))


SYMBOLS = "".join(f" %{j}" for j in range(60))


def bad_lines(i):
    return "\n".join([f"same line {i} again"] * 15 + [good(i)])


def test_a_habit_of_the_host_counts(spark):
    """The same failing text stays on a good host and goes on a bad one; clean texts stay on both."""
    rows = [(i, "good", good(i)) for i in range(60)] + [(100, "good", bad_lines(0).replace("again", ""))]
    rows += [(200 + i, "bad", good(i) + SYMBOLS) for i in range(60)] + [(300, "bad", good(300))]
    rows += [(400, "good", good(400) + SYMBOLS), (500, "junk", good(500))]
    rows += [(600 + i, "junk", "too short") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    kept = {r["doc_id"] for r in keep_good(docs).collect()}
    assert kept == {*range(60), 100, 300, 400}
    shuffled = {r["doc_id"] for r in keep_good(docs, Limits(broadcast_hosts=0)).collect()}
    assert shuffled == kept


def test_one_host_and_no_failures(spark):
    docs = spark.createDataFrame([(1, None, good(1)), (2, None, good(2))], "doc_id long, source string, text string")
    assert keep_good(docs).count() == 2
    verdicts, hosts = host_verdicts(measure(docs))
    assert hosts == 1 and not any(verdicts.first()[1:])


def test_prior_finds_the_parameters():
    random = np.random.RandomState(1)
    rates = random.beta(2, 6, 4000)
    n = random.randint(20, 60, 4000)
    f = random.binomial(n, rates)
    a, b = beta_prior(len(n), n.sum(), (n * n).sum(), f.sum(), (f * f / n).sum())
    assert abs(a - 2) < 0.3 and abs(b - 6) < 0.9
    assert beta_prior(0, 0, 0, 0, 0) == (1.0, 1.0)


def test_long_text_is_whole():
    assert document_stats(LONG + "\n" + "%" * 1000)[2] == 1000
