import hashlib
import random

import numpy as np
import pytest
from llm_fixtures import words

from sensorlake.llm import exact_dedup as ed

UPPER = {c: c + 32 for c in range(65, 91)}


def brute(rows):
    """(doc_id, keep_id, group_size, sha) of every row, sorted."""
    low = [(i, (t or "").translate(UPPER)) for i, t in rows]
    groups = {}
    for i, t in low:
        groups.setdefault(t, []).append(i)
    out = []
    for i, t in low:
        known = [x for x in groups[t] if x is not None]
        sha = hashlib.sha256(t.encode()).hexdigest()
        out.append((i, max(known) if known else None, len(groups[t]), sha))
    return sorted(out, key=repr)


def found(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return ed.repeats(df).collect()


def check(spark, rows):
    got = found(spark, rows)
    assert sorted(((r[0], r[1], r[2], r[4]) for r in got), key=repr) == brute(rows)
    assert all(not r["kept"] or r["doc_id"] == r["keep_id"] for r in got)
    kept = [r["text_sha256"] for r in got if r["kept"]]
    assert len(kept) == len(set(kept)) == len({r["text_sha256"] for r in got})


@pytest.mark.parametrize("n", [0, 1, 2, 7, 1000, 20_000])
def test_perfect_hash(n):
    words = np.random.default_rng(n).integers(0, 1 << 63, (n, 4), dtype=np.uint64)
    sizes, bits = ed.PerfectHash.of(words)
    hashed = ed.PerfectHash(sizes, bits)
    assert sorted(hashed.slots(words)) == list(range(n))
    assert sum(sizes) <= 5 * n + 200
    others = words ^ np.uint64(1)
    assert ((hashed.slots(others) >= -1) & (hashed.slots(others) < max(n, 1))).all()


def test_copies_of_all_sizes(spark):
    rng = random.Random(3)
    texts = [" ".join(words(rng, 8)) for _ in range(150)]
    rows = [(i, rng.choice(texts[: 1 + i // 4])) for i in range(500)]
    rows += [(1000 + i, "The Same Text") for i in range(300)]
    rows += [(2000, "the same text"), (2001, "ÉTÉ"), (2002, "été"), (2003, "THE same text ")]
    rng.shuffle(rows)
    check(spark, rows)


def test_nulls_ties_and_long_texts(spark):
    long = "Ab" * 500_000
    rows = [
        (None, "x"), (None, "x"), (None, "y"), (3, "Y"), (4, None), (5, ""), (5, ""), (None, None),
        (7, "same"), (7, "same"), (7, "SAME"), (1, long), (2, long.lower()), (6, long + "."),
        (-5, "negative"), (-9, "negative"),
    ]
    check(spark, rows)
    got = [r for r in found(spark, rows) if r["doc_id"] == 7]
    assert [r["kept"] for r in got].count(True) == 1


def test_nothing(spark, no_docs):
    assert ed.repeats(no_docs).collect() == []
    assert ed.drop_repeats(no_docs).collect() == []


def test_columns_of_the_same_names(odd):
    rows = odd.withColumnsRenamed({"key": "digest", "row": "winner", "uid": "place", "votes": "n"})
    kept = ed.drop_repeats(rows)
    assert kept.columns == rows.columns
    texts = [(r["text"] or "") for r in rows.collect()]
    assert len({t.translate(UPPER) for t in texts}) == kept.count()


def test_history_of_an_earlier_load(spark):
    """A second load only needs the index of the first."""
    first = spark.createDataFrame([(1, "a"), (2, "A"), (9, "b")], "doc_id long, text string")
    later = spark.createDataFrame([(5, "a"), (6, "c"), (7, "C")], "doc_id long, text string")
    digested = [ed.grouped(ed._digested(x)) for x in (first, later)]
    index = ed.build(digested[0], 8)
    got = {
        (r["winner"]["doc_id"], r["n"], r["known"])
        for r in ed.arrive(digested[1], index, 8).collect()
    }
    assert got == {(5, 3, True), (9, 1, True), (7, 2, False)}


def test_bytes_decide(spark):
    """A digest that hashes to a slot in use is not taken for the one in the slot."""
    raw = np.random.default_rng(1).integers(0, 1 << 63, (400, 4), dtype=np.uint64)
    rows = [(raw[i].tobytes(), (i, i), 1) for i in range(400)]
    kind = "digest binary, winner struct<doc_id:long,place:long>, n long"
    known = spark.createDataFrame(rows[:200], kind)
    later = spark.createDataFrame(rows[200:], kind)
    got = ed.arrive(later, ed.build(known, 2), 2).collect()
    assert sorted(r["winner"]["doc_id"] for r in got) == list(range(400))
    assert {r["known"] for r in got if r["winner"]["doc_id"] >= 200} == {False}
