"""Predictions against the method in plain Python: counts in dictionaries, sums in loops."""

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from fareflow.llm.language import Settings, buckets, predictions
from tests.llm.test_language import text


def maximise(count, chance, langs, rounds):
    """Proportions by expectation and maximisation, and the log-likelihood under them."""
    total = sum(count.values())
    parts = {x: 1 / len(langs) for x in langs}
    for _ in range(rounds if len(langs) > 1 else 0):
        new = defaultdict(float)
        for gram, n in count.items():
            each = {x: parts[x] * chance[x][gram] for x in langs}
            whole = sum(each.values())
            for x in langs:
                new[x] += n * each[x] / whole
        parts = {x: new[x] / total for x in langs}
    return parts, sum(n * math.log(sum(parts[x] * chance[x][g] for x in langs)) for g, n in count.items())


def predict(value, chance, langs, settings):
    if not value or not any(c.isalpha() for c in value):
        return "und", 0.0
    count = Counter(buckets(value, settings.bits).tolist())
    whole, _ = maximise(count, chance, langs, settings.rounds)
    alone = {x: sum(n * math.log(chance[x][g]) for g, n in count.items()) for x in langs}
    first = max(langs, key=lambda x: alone[x])
    order = [first, *sorted((x for x in langs if x != first), key=lambda x: -whole[x])]
    price = settings.penalty * 0.5 * math.log(max(sum(count.values()), 2))
    chosen, best = {first: 1.0}, alone[first]
    for k in range(2, len(order) + 1):
        parts, likelihood = maximise(count, chance, order[:k], settings.rounds)
        if likelihood - (k - 1) * price <= best:
            break
        chosen, best = parts, likelihood - (k - 1) * price
    winner = max(chosen, key=lambda x: (chosen[x], -langs.index(x)))
    return winner, chosen[winner]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain_python(spark, seed):
    pick, settings = random.Random(seed), Settings()
    rows = []
    for i in range(160):
        lang = pick.choice(["xa", "xb", "xc"])
        value = text(lang, pick.choice([1, 3, 20, 200]), pick)
        if pick.random() < 0.3:
            value += " " + text(pick.choice(["xa", "xb", "xc"]), pick.choice([5, 100]), pick)
        rows.append((i, pick.choice([value, value, value, value, "", None, "12 !"]), pick.choice([lang, lang, None])))
    counts = defaultdict(Counter)
    for i, value, lang in rows:
        if lang and value is not None and zlib.crc32(str(i).encode()) % 5:
            counts[lang].update(buckets(value, settings.bits).tolist())
    langs, size = sorted(counts), 1 << settings.bits
    chance = {}
    for x in langs:
        total = counts[x].total() + settings.smoothing * size
        chance[x] = defaultdict(lambda t=total: settings.smoothing / t, {g: (n + settings.smoothing) / total for g, n in counts[x].items()})
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = {r["doc_id"]: r for r in predictions(docs).collect()}
    for i, value, _ in rows:
        lang, score = predict(value, chance, langs, settings)
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert got[i]["lang_pred"] == lang and got[i]["score"] == pytest.approx(score, abs=1e-3), (i, value)
