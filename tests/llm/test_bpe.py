import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fareflow.llm import byte_bpe, token_counts
from fareflow.llm.queries import BYTE_BPE, MULTI_BPE
from tests.llm.conftest import ODD

PATTERN = public_tokenizers.PATTERN
TEXTS = st.text(st.characters(exclude_categories=["Cs"]), max_size=80) | st.text("ab 'st\n\t\x1c\x85½é1", max_size=80)


@pytest.fixture(scope="module")
def reference():
    ranks = {piece: rank for rank, piece in enumerate(byte_bpe.read_ranks(MULTI_BPE))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_BPE)


def sha(data):
    return hashlib.sha256(data).hexdigest()


@settings(max_examples=400, deadline=None)
@given(text=TEXTS)
def test_ids_are_the_library_s(reference, text):
    ids = byte_bpe.codec(MULTI_BPE, PATTERN).encode([text])[0]
    assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
    assert byte_bpe.codec(MULTI_BPE, PATTERN).decode(ids) == text.encode()


def test_long_pieces_and_a_full_memory(reference, monkeypatch):
    engine = byte_bpe.Codec(byte_bpe.read_ranks(MULTI_BPE), PATTERN)
    monkeypatch.setattr(byte_bpe, "MEMO", 10)
    texts = ["x" * 100_000, "abc " * 50 + "é" * 300, " ".join(f"q{i}" for i in range(99)), "abc", ""]
    for _ in range(2):
        got = [np.frombuffer(x, "<u4").tolist() for x in engine.encode(texts)]
        assert got == [reference.encode_ordinary(t) for t in texts]


def test_odd_rows(odd, none, reference):
    rows = byte_bpe.digests(odd, MULTI_BPE, PATTERN, drop=("text",)).collect()
    want = []
    for _, text, _, _ in ODD:
        ids = reference.encode_ordinary(text or "")
        want.append((len(ids), sha(np.array(ids, "<u4").tobytes()), sha((text or "").encode())))
    assert sorted((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows) == sorted(want)
    assert byte_bpe.digests(none, MULTI_BPE, PATTERN).count() == 0


def test_round_trip(odd):
    encoded = byte_bpe.encode_documents(odd, MULTI_BPE, PATTERN)
    assert dict(encoded.dtypes)["ids"] == "array<int>"
    decoded = byte_bpe.decode_documents(encoded, MULTI_BPE)
    assert all(bytes(r["decoded"]).decode() == (r["text"] or "") for r in decoded.collect())


@settings(max_examples=400, deadline=None)
@given(text=TEXTS | st.just("a<|endoftext|> b"))
def test_counts_are_the_library_s(library, text):
    want = len(library.encode(text, add_special_tokens=False).ids)
    assert token_counts.counter(BYTE_BPE, PATTERN).counts([text, None]) == [want, 0]


def test_cache(spark, odd, none, library, folder):
    def counted(docs):
        rows = token_counts.token_counts(docs, folder, BYTE_BPE, PATTERN).collect()
        return sorted(((r["doc_id"] or 0), r["n_bytes"], r["n_tokens"]) for r in rows)

    want = sorted(
        ((i or 0), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids))
        for i, t, _, _ in ODD
    )
    assert counted(none) == []
    assert counted(odd.limit(5).union(odd.limit(5))) and counted(odd) == want
    stored = spark.read.parquet(folder)
    assert stored.count() == stored.distinct().count() == len({t or "" for _, t, _, _ in ODD})
    # A count that is stored is taken from there; another tokenizer's is not.
    files = spark.read.parquet(folder).count()
    assert counted(odd) == want and spark.read.parquet(folder).count() == files
    spark.createDataFrame([(b"1" * 32, "other", 9)], token_counts.CACHE).write.mode("append").parquet(folder)
    assert counted(odd) == want
