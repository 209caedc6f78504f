"""Base counts against plain Python, and the estimates against plain arithmetic."""

import re
from collections import Counter

import pytest
from llm_fixtures import odd_texts, rows_of
from pyspark.sql import functions as F

from sensorlake.llm import quality

SPACE = r"\x20\x09-\x0D"


def brute(text):
    text = text or ""
    words = re.findall(f"[^{SPACE}]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            inside |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(f"[^{SPACE}]", line):
            dup += line in seen
            seen.add(line)
    n, repeated = len(words), len(inside)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = n < 50 or 100 * repeated > 50 * n
    return n, sum(map(len, words)), symbols, dup, repeated, failed


TEXTS = [
    "a b c a b c", "a a a a a", "a b", "a b c", "x y z\nx y z\n\n \nq", "| # | * <a>",
    "a b c d a b c e b c d", " \x0b\x0c\r\n", "Ünï cödé \U0001f600 x",
]


def test_counts(spark, odd, no_docs):
    more = [(100 + i, t) for i, t in enumerate(TEXTS)]
    docs = odd.select("doc_id", "text").unionAll(spark.createDataFrame(more, "doc_id long, text string"))
    found = quality.verdicts(docs).drop("posterior", "votes")
    expected = [(i, *brute(t)) for i, t in [*odd_texts(), *more]]
    assert rows_of(found.drop("kept")) == sorted(expected, key=repr)
    assert found.where("kept and base_failed").count() == 0
    assert quality.verdicts(no_docs).count() == 0


def estimates(patterns, n_rules):
    share = quality.START_SHARE
    good = [list(quality.START_ON_GOOD) for _ in range(n_rules)]
    bad = [list(quality.START_ON_BAD) for _ in range(n_rules)]

    def bounded(x):
        return min(1 - quality.MARGIN, max(quality.MARGIN, x))

    for _ in range(quality.ROUNDS):
        total = sum(patterns.values())
        on_good = [[0.0] * 3 for _ in range(n_rules)]
        on_bad = [[0.0] * 3 for _ in range(n_rules)]
        mass = 0.0
        for votes, n in patterns.items():
            yes, no = share, 1 - share
            for j, v in enumerate(votes):
                yes, no = yes * good[j][v + 1], no * bad[j][v + 1]
            p = yes / (yes + no)
            mass += n * p
            for j, v in enumerate(votes):
                on_good[j][v + 1] += n * p
                on_bad[j][v + 1] += n * (1 - p)
        share = bounded(mass / total)
        good = [[bounded(x / (share * total)) for x in row] for row in on_good]
        bad = [[bounded(x / ((1 - share) * total)) for x in row] for row in on_bad]
    return share, sum(good, []), sum(bad, [])


def test_estimates(spark):
    patterns = {(1, 1, 1): 80, (0, 1, 1): 10, (-1, -1, 0): 9, (-1, -1, 1): 4, (1, 0, 0): 7}
    rows = [(list(v),) for v, n in patterns.items() for _ in range(n)]
    voted = spark.createDataFrame(rows, "votes array<int>")
    found = quality.estimates(voted, 3)
    expected = estimates(patterns, 3)
    assert found[0] == pytest.approx(expected[0], abs=1e-9)
    assert found[1] == pytest.approx(expected[1], abs=1e-9)
    assert found[2] == pytest.approx(expected[2], abs=1e-9)
    bad = quality.posterior(F.lit(found[0]), found[1], found[2], F.col("votes"), 3) < 0.5
    assert voted.where(bad).where(F.array_contains("votes", -1)).count() == 13
    assert voted.where(bad).where("votes[1] = 1").count() == 0


def test_verdicts_agree_with_labels(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = quality.verdicts(docs).join(labels, "doc_id").where("not base_failed")
    counts = {(r[0], r[1]): r[2] for r in found.groupBy("quality", "kept").count().collect()}
    assert counts.get((1, True), 0) > 0.97 * sum(n for (q, _), n in counts.items() if q == 1)
    assert counts.get((0, False), 0) > counts.get((0, True), 0)


def test_stage_keeps_columns(odd, no_docs):
    kept = quality.drop_poor(odd)
    assert kept.dtypes == odd.dtypes
    ids = [r[0] for r in kept.select("doc_id").collect()]
    assert 12 in ids and not {4, 6, 7, 8, 9, 10} & set(ids)
    assert quality.drop_poor(no_docs).count() == 0
