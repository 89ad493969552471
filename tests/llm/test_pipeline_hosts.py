"""The quality stage of the pipeline keeps the clean documents of a host that fails as a whole."""

from corpus_pipeline import good as stage
from fareflow.llm.quality import Limits, keep_good
from tests.llm.test_quality import SYMBOLS, bad_lines, good


def test_clean_documents_of_a_failing_host_stay(spark):
    rows = [(i, "good", good(i)) for i in range(60)] + [(100, "good", good(100) + SYMBOLS)]
    rows += [(500 + i, "junk", good(500 + i)) for i in range(3)]
    rows += [(510, "junk", good(510) + SYMBOLS), (511, "junk", bad_lines(511)), (512, "junk", "x" * 40 + " " + good(512))]
    rows += [(513, "junk", " ".join("abcdefghijklmno" + str(j) for j in range(60)))]
    rows += [(600 + i, "junk", "too short") for i in range(400)] + [(2000, None, good(2000))]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    kept = {r["doc_id"] for r in stage(spark, docs, None).collect()}
    assert kept == {*range(60), 100, 500, 501, 502, 512, 2000}
    shuffled = keep_good(docs, Limits(spare_clean=True, broadcast_hosts=0))
    assert {r["doc_id"] for r in shuffled.collect()} == kept
