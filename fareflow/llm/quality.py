"""Quality rules: what a document breaks by itself, and what its host breaks as a habit.

A document fails at once when it is short or repeats itself. The softer rules (symbols, repeated
lines, odd word lengths) are noisy on one document, so they count only where the host is known for
them: failures are summed by host, each host's rate is shrunk towards an empirical beta prior, and
the verdict goes back to the host's documents.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import BLANKS, free_name, map_rows, words, written

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_lines long, n_repeat_words long"


@dataclass(frozen=True)
class Limits:
    """When a document breaks a rule, and when a host does."""

    least_words: int = 50
    repeat_share: float = 0.5
    symbol_share: float = 0.1
    dup_line_share: float = 0.3
    word_length: tuple[int, int] = (3, 12)
    #: A host has a habit if its failure rate is above this with the certainty below.
    host_rate: float = 0.3
    #: A host of which this share fails the base rules goes as a whole.
    host_reject: float = 0.9
    #: Of such a host, documents that break no rule at all stay.
    spare_clean: bool = False
    certainty_sd: float = 1.645
    #: The verdicts are broadcast up to so many hosts (about 100 bytes each), else joined by shuffle.
    broadcast_hosts: int = 100_000


def document_stats(text: str | None) -> tuple[int, int, int, int, int, int]:
    """The values of STATS for one text; no text has no words and no lines."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    found = words(text)
    symbols = sum(text.count(c) for c in SYMBOLS)
    chars = len(text) - sum(text.count(c) for c in BLANKS)
    lines = Counter(line for line in text.split("\n") if line.strip(BLANKS))
    windows = list(zip(found, found[1:], found[2:]))
    count = Counter(windows)
    covered, reach = 0, 0
    if len(count) < len(windows):
        for i, window in enumerate(windows):
            if count[window] > 1:
                covered += i + 3 - max(i, reach)
                reach = i + 3
    total = sum(lines.values())
    return len(found), chars, symbols, total - len(lines), total, covered


def measure(docs: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """The documents with the columns of STATS, which replace columns of those names."""

    def make():
        def compute(batch: pa.RecordBatch):
            stats = [document_stats(t) for t in batch.column("text").to_pylist()]
            names = [x.split()[0] for x in STATS.split(", ")]
            return {n: [s[i] for s in stats] for i, n in enumerate(names)}

        return compute

    return map_rows(docs, make, STATS, drop)


def _failures(limits: Limits) -> dict[str, Column]:
    """Rule -> whether a measured document breaks it. The first is the base rule."""
    n, c = F.col("n_words"), F.col
    length = c("word_chars") / F.greatest(n, F.lit(1))
    return {
        "base": (n < limits.least_words) | (c("n_repeat_words") > limits.repeat_share * n),
        "symbols": c("n_symbols") > limits.symbol_share * n,
        "lines": c("n_dup_lines") > limits.dup_line_share * c("n_lines"),
        "length": (n > 0) & ~length.between(*limits.word_length),
    }


def beta_prior(hosts: float, rows: float, square: float, failed: float, spread: float) -> tuple[float, float]:
    """The beta prior of the hosts' failure rates, by moments.

    ``square`` is the sum of n^2 and ``spread`` that of f^2 / n over hosts with n documents, f of
    them failed. The chance part of the variance is taken off; hosts that differ by chance only give a
    strong prior (at most 10,000 documents' worth), a single host a weak one.
    """
    if not rows:
        return 1.0, 1.0
    mean = failed / rows
    strength = 2.0
    if hosts > 1:
        between = (spread - rows * mean * mean) / (hosts - 1) - mean * (1 - mean)
        between /= max((rows - square / rows) / (hosts - 1), 1e-9)
        strength = 10_000.0 if between <= 0 else min(max(mean * (1 - mean) / between - 1, 2.0), 10_000.0)
    return max(mean * strength, 1e-6), max((1 - mean) * strength, 1e-6)


def host_verdicts(measured: DataFrame, limits: Limits = Limits()) -> tuple[DataFrame, int]:
    """One row per host: its source, and for each rule whether the host breaks it; and how many there are.

    Failures are summed in each task before the shuffle, so a hot host is a row per task. One row of
    sums over the hosts comes to the driver, for the prior.
    """
    rules = _failures(limits)
    flags = [F.sum(v.cast("long")).alias(f"f_{k}") for k, v in rules.items()]
    hosts = written(measured.groupBy("source").agg(F.count(F.lit(1)).alias("n"), *flags), "hosts")
    n = F.col("n").cast("double")
    sums = [F.count(F.lit(1)).alias("hosts"), F.sum(n).alias("rows"), F.sum(n * n).alias("square")]
    for rule in rules:
        f = F.col(f"f_{rule}").cast("double")
        sums += [F.sum(f).alias(f"s_{rule}"), F.sum(f * f / n).alias(f"q_{rule}")]
    total = hosts.agg(*sums).first()
    verdict = []
    for rule in rules:
        a, b = beta_prior(
            total["hosts"], total["rows"], total["square"], total[f"s_{rule}"], total[f"q_{rule}"]
        )
        f = F.col(f"f_{rule}")
        a, b = f + F.lit(a), F.col("n") - f + F.lit(b)
        mean, sd = a / (a + b), F.sqrt(a * b / (a + b + 1)) / (a + b)
        limit = limits.host_reject if rule == "base" else limits.host_rate
        verdict.append((mean - limits.certainty_sd * sd > limit).alias(f"host_{rule}"))
    return hosts.select(F.col("source").alias("host"), *verdict), total["hosts"]


def judge(measured: DataFrame, verdicts: DataFrame, hosts: int, limits: Limits = Limits()) -> DataFrame:
    """The measured documents with ``base_failed`` and ``kept``.

    A null source is a host of its own. Verdicts are broadcast while their counted number is small;
    beyond that the join shuffles, and adaptive execution splits a hot host.
    """
    rules = _failures(limits)
    verdicts = verdicts.filter(" or ".join(f"host_{k}" for k in rules))
    for name in verdicts.columns:
        verdicts = verdicts.withColumnRenamed(name, free_name(measured.columns, name))
    host, *flags = verdicts.columns
    if hosts <= limits.broadcast_hosts:
        verdicts = F.broadcast(verdicts)
    rows = measured.join(verdicts, measured["source"].eqNullSafe(verdicts[host]), "left")
    base, *soft = zip(rules, flags)
    bad = F.coalesce(F.col(base[1]), F.lit(False))
    if limits.spare_clean:
        broken = [rules[rule] for rule, _ in soft]
        bad = bad & F.greatest(*broken)
    for rule, flag in soft:
        bad = bad | (F.coalesce(F.col(flag), F.lit(False)) & rules[rule])
    failed = rules["base"]
    return (
        rows.withColumn("base_failed", failed).withColumn("kept", ~failed & ~bad).drop(*verdicts.columns)
    )


def quality(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """doc_id, source, the statistics, ``base_failed`` and ``kept`` of every row of ``docs``.

    Texts that are null or empty fail; repeated rows are judged alike; an empty table gives none.
    """
    measured = written(measure(docs.select("doc_id", "source", "text"), drop=("text",)), "stats")
    return judge(measured, *host_verdicts(measured, limits), limits)


def keep_good(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns as they are.

    The statistics are computed twice, for the hosts and for the documents: cheaper than moving or
    storing the texts once more.
    """
    verdicts, hosts = host_verdicts(measure(docs.select("source", "text"), drop=("text",)), limits)
    taken = [x.split()[0] for x in STATS.split(", ")] + ["base_failed", "kept"]
    hidden = {}
    for name in docs.columns:
        if name.lower() in taken:
            hidden[name] = free_name([*docs.columns, *taken, *hidden.values()], name + "_own")
    judged = judge(measure(docs.withColumnsRenamed(hidden)), verdicts, hosts, limits)
    return judged.filter("kept").select(*[F.col(hidden.get(c, c)).alias(c) for c in docs.columns])
