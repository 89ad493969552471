import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from fareflow.llm import chat
from fareflow.llm.queries import BYTE_BPE

PIECES = st.sampled_from([*chat.CONTROL, "\\", "\\n", "n", "\n", " ", "  x", "é", "😀", "a b", "<", "|", "assistant", "\x1c"])
TEXT = st.lists(PIECES, max_size=8).map("".join)
TURNS = st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "a\nb", "", None]) | TEXT, TEXT | st.none()), max_size=6)


def check(turns):
    segments = list(chat.render(turns, BYTE_BPE))
    read = [t for s in segments for t in s.turns()]
    assert read == [(r or "", t or "") for r, t in turns]
    assert "".join(s.loss_text() for s in segments) == "".join(t or "" for r, t in turns if r == "assistant")
    for s in segments:
        for role, text in s.turns():
            assert not any(c in chat.escape(text) or c in chat.escape_role(role) for c in chat.CONTROL)
    return segments


@settings(max_examples=300, deadline=None)
@given(TURNS)
def test_read_back(turns):
    check(turns)


def test_segments_of_a_long_conversation(monkeypatch):
    turns = [("user" if i % 2 else "assistant", f" turn {i} " * 30) for i in range(200)]
    whole = check(turns)
    monkeypatch.setattr(chat, "SEGMENT_CHARS", 1000)
    parts = check(turns)
    assert len(whole) == 1 and len(parts) > 20
    assert "".join(s.text for s in parts) == whole[0].text


def test_tokens_are_the_library_s_and_marked_if_they_touch_a_span():
    (segment,) = chat.render([("user", "hi"), ("assistant", " a\n"), ("assistant", "")], BYTE_BPE)
    encoded = chat._library(BYTE_BPE).encode(segment.text, add_special_tokens=False)
    assert segment.ids == encoded.ids
    start = segment.text.index(" a\n")
    touch = [a < start + 3 and b > start for a, b in encoded.offsets]
    assert (segment.loss[:, 1] > segment.loss[:, 0]).tolist() == touch


def test_intersection():
    tokens = np.array([[0, 2], [2, 5], [5, 5], [5, 9], [9, 12], [12, 13]])
    spans = np.array([[1, 4], [9, 10], [12, 13]])
    assert chat.intersect(tokens, spans).tolist() == [[1, 2], [2, 4], [0, 0], [0, 0], [9, 10], [12, 13]]
    assert not chat.intersect(tokens, np.empty((0, 2), np.int64)).any()


def test_rows(spark):
    rows = [
        (1, 2, "assistant", "b"), (1, 0, "user", "a"), (1, 1, "user", None), (1, 1, "user", None),
        (2, 0, None, ""), (None, 0, "user", "x"), (3, None, "assistant", "y"), (3, 0, "assistant", "z"),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS n_turns")
    got = {r["conv_id"]: r for r in chat.digests(chat.with_extra(table), BYTE_BPE).collect()}
    assert set(got) == {1, 2, 3, None, -7}

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    assert got[1]["n_turns"] == 4 and got[1]["turns_sha256"] == sha("user\na\nuser\n\nuser\n\nassistant\nb\n")
    assert got[1]["loss_chars"] == 1 and got[1]["loss_sha256"] == sha("b")
    assert got[3]["loss_sha256"] == sha("yz") and got[2]["turns_sha256"] == sha("\n\n")
    ok = "</s>[INST] ok [/INST]"
    assert got[-7]["loss_sha256"] == sha(ok) and got[-7]["loss_chars"] == len(ok)
    assert got[-7]["turns_sha256"] == sha(f"user\n{ok}\nassistant\n{ok}\n")
    formatted = chat.format_conversations(table, BYTE_BPE).collect()
    assert all(len(r["ids"]) == len(r["starts"]) == len(r["ends"]) == len(r["loss"]) for r in formatted)
    assert {r["conv_id"]: len(r["formatted"]) for r in formatted} == {
        k: r["formatted_chars"] for k, r in got.items() if k != -7
    }
    assert chat.digests(table.limit(0), BYTE_BPE).count() == 0
