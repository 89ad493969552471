"""The pipeline's rows against its stages in plain Python."""

import hashlib
import math
from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from fareflow.llm import byte_bpe
from fareflow.llm.common import written
from fareflow.llm.queries import MULTI_BPE
from tests.llm.brute import blank_split, documents, near_components, without_common_lines
from tests.llm.test_mixing import brute_targets

SOURCES = ["a", "b", "c", "d"]


def repeats(words):
    windows = Counter(zip(words, words[1:], words[2:]))
    return len({j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)})


def brute(rows):
    """The ids' digests by doc_id, as often as they occur; rows: (doc_id, text, source)."""
    source = {i: s for i, _, s in rows}
    kept = []
    for i, text, _ in rows:
        words = blank_split(text)
        if len(words) >= 50 and 100 * repeats(words) <= 50 * len(words):
            kept.append((i, text))
    kept = [(i, "\n".join(rest)) for i, (_, rest) in without_common_lines(kept).items()]
    near = near_components(kept, percent=80)
    kept = [(i, text) for i, text in kept if near[i][1] == i]
    sizes = Counter()
    for i, text in kept:
        sizes[source[i]] += len(blank_split(text))
    targets = brute_targets(sizes)
    ranks = {piece: rank for rank, piece in enumerate(byte_bpe.read_ranks(MULTI_BPE))}
    library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = Counter()
    for i, text in kept:
        rate = targets[source[i]] / sizes[source[i]]
        draw = hashlib.md5(f"mix-1|{i}|{hashlib.md5(text.encode()).hexdigest()}".encode()).hexdigest()
        copies = math.floor(rate) + (int(draw[:13], 16) / 2**52 < rate - math.floor(rate))
        ids = np.array(library.encode_ordinary(text), "<u4").tobytes()
        out[i, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += copies
    return +out


def test_against_brute_force(spark, folder):
    rows = [(i, text, SOURCES[i % 4]) for i, text in documents(400, seed=8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs = docs.selectExpr("doc_id", "text", "'en' AS lang", "source", "cast(length(text) AS long) AS n_chars", "1 AS kept")
    docs.repartition(6).write.parquet(f"{folder}/documents.parquet")
    got = Counter(tuple(r) for r in corpus_pipeline.run(spark, folder).select("doc_id", "ids_sha256", "decoded_sha256").collect())
    want = brute(rows)
    assert got == want
    assert 30 < len(want) < sum(want.values())


def test_stages_keep_the_columns_and_take_odd_rows(spark, odd, none):
    for docs in (odd, none):
        docs = docs.withColumn("more", docs["text"])
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = written(stage(spark, docs, None), name.replace(" ", "-"))
            assert out.columns == docs.columns
        last = corpus_pipeline.STAGES[-1][1](spark, docs, None)
        assert last.count() == docs.count()
