"""Benchmark passages against a search of every window in every document."""

import hashlib
import random
import re

import pyarrow as pa
import pytest
from llm_fixtures import odd_texts, rows_of, words

from sensorlake.llm import winnow
from sensorlake.llm import words as word_arrays

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def split(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = split(text)
        k = min(10, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            windows.setdefault(k, {}).setdefault(tuple(w[i : i + k]), set()).add(item)
    out = []
    for doc_id, text in docs:
        w, hit, found = split(text), set(), set()
        for k, known in windows.items():
            for i in range(len(w) - k + 1):
                own = known.get(tuple(w[i : i + k]))
                if own:
                    hit |= set(range(i, i + k))
                    found |= own - {None}
        ids = ",".join(sorted(map(str, found)))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def tables(seed=6):
    rng = random.Random(seed)
    items = [(i, " ".join(words(rng, rng.randint(10, 40)))) for i in range(30)]
    passage = items[0][1].split()
    items += [
        (30, "Short item, here"), (31, "one"), (32, None), (33, "?!"), (2, "other text of item two " * 4),
        (None, " ".join(words(rng, 15))), (34, items[5][1]), (35, "a " * 40), (36, "ab " * 10),
        (37, " ".join(passage[:10] * 2)),
    ]
    docs = []
    for i in range(120):
        text = words(rng, rng.randint(0, 60), "ae")
        for _ in range(rng.randint(0, 3)):
            w = split(rng.choice(items)[1])
            lo = rng.randint(0, max(0, len(w) - 1))
            part = [x.upper() if rng.random() < 0.1 else x for x in w[lo : lo + rng.randint(5, 40)]]
            text[rng.randint(0, len(text)) : 0] = part
        docs.append((100 + i, ", ".join(text)))
    docs += [(300, "a " * 100), (301, "b one c"), (302, "ab a " * 30)]
    return docs + odd_texts(), items


@pytest.mark.parametrize("block", [1 << 20, 2000])
def test_hits(spark, block):
    docs, items = tables()
    found = winnow.scan(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        block_bytes=block,
    )
    expected = brute(docs, items)
    assert rows_of(winnow.digests(found)) == expected
    assert sum(r[5] for r in expected) > 60


def test_small_slices(monkeypatch):
    monkeypatch.setattr(word_arrays, "SLICE_BYTES", 300)
    docs, items = tables(7)
    index = winnow.Index(items)
    found = winnow.scanned(pa.array([t for _, t in docs]), index).to_pylist()
    for (doc_id, text), got in zip(docs, found):
        want = brute([(doc_id, text)], items)[0]
        assert got["n_words"] == want[1]
        assert sum(s["last"] - s["first"] for s in got["spans"]) == want[2]
        assert len(got["items"]) == want[3]


def test_empty_tables(spark, odd, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "words")], "item_id long, text string")
    assert winnow.digests(winnow.scan(odd, none)).where("contaminated").count() == 0
    assert winnow.scan(no_docs, some).count() == 0
    assert winnow.drop_contaminated(no_docs, some).count() == 0


def test_stage_drops_contaminated_rows(spark, odd):
    text = next(t for i, t in odd_texts() if i == 3)
    items = spark.createDataFrame([(1, " ".join(text.split()[5:25]))], "item_id long, text string")
    kept = winnow.drop_contaminated(odd, items)
    assert kept.dtypes == odd.dtypes
    assert {1, 2, 3} & {r[0] for r in kept.select("doc_id").collect()} == set()
    assert kept.count() == odd.count() - 4
