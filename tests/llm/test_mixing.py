import pytest

from fareflow.llm.mixing import Settings, mix, mixed, targets
from tests.conftest import SMALL


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, left, rest = {}, share * sum(sizes.values()), set(order)
    while rest:
        level = left / sum(weight[s] for s in rest)
        cut = {s for s in rest if most * sizes[s] < weight[s] * level}
        if not cut:
            return out | {s: weight[s] * level for s in rest}
        out |= {s: most * sizes[s] for s in cut}
        left -= sum(most * sizes[s] for s in cut)
        rest -= cut
    return out


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 10, "b": 1000, "c": 50, None: 7, "B": 300, "é": 0},
        {"a": 5},
        {None: 0, "a": 0},
        {f"s{i}": (i * 7919) % 1000 for i in range(200)},
    ],
)
def test_targets(spark, sizes):
    rows = [(s, n) for s, n in sizes.items()]
    table, n = targets(spark.createDataFrame(rows, "source string, size long").repartition(5))
    got = {r["source"]: r["target"] for r in table.collect()}
    assert n == len(sizes) and got == pytest.approx(brute_targets(sizes))
    assert sum(got.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_taken_is_near_the_targets_and_copies_agree(spark):
    docs = spark.createDataFrame(
        [(i, " ".join(["w"] * (1 + i % 30)), f"s{i % 4}") for i in range(8000)], "doc_id long, text string, source string"
    ).selectExpr("*", "1 AS size", "2 AS mix_target")
    rows = mixed(docs).collect()
    total, target = {}, {}
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    for r in rows:
        total[source[r["doc_id"]]] = total.get(source[r["doc_id"]], 0) + r["taken"]
        target[source[r["doc_id"]]] = r["target"]
        assert r["taken"] % r["size"] == 0 and 0 <= r["taken"] <= 2 * r["size"]
    for s in target:
        assert total[s] == pytest.approx(target[s], rel=0.05)
    out = mix(docs)
    assert out.columns == docs.columns
    copies = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert copies == {r["doc_id"]: r["taken"] // r["size"] for r in rows if r["taken"]}
    assert sorted(mixed(docs.repartition(3)).collect()) == sorted(rows)
    shuffled = Settings(broadcast_sources=0)
    assert sorted(mixed(docs, shuffled).collect()) == sorted(rows)


def test_odd_rows(spark, odd, none):
    rows = mixed(odd).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert r["taken"] <= 2 * r["size"] and r["target"] <= 2 * r["source_size"]
    assert mix(odd).columns == odd.columns
    assert mixed(none).count() == mix(none).count() == 0
    assert spark.read.parquet(f"{SMALL}/documents.parquet").count() == mixed(spark.read.parquet(f"{SMALL}/documents.parquet")).count()
