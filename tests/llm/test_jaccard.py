"""Near copies against all pairs by brute force."""

import random
import re

import pytest
from llm_fixtures import odd_texts, rows_of, words

from sensorlake.llm import jaccard

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def shingles(text):
    found = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = min(5, len(found))
    return {tuple(found[i : i + n]) for i in range(len(found) - n + 1)} if n else set()


def brute(rows, threshold=0.8):
    """(doc_id, class_id, n_links) of every row."""
    sets = [shingles(t) for _, t in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= threshold * len(a | b) - 1e-9:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        own = [d for k, (d, _) in enumerate(rows) if find(k) == find(i) and d is not None]
        out.append((doc_id, min(own, default=None), links[i]))
    return sorted(out, key=repr)


def chains(seed, n):
    """Texts that drift by a word at a time, so that ends of a chain are not similar."""
    rng = random.Random(seed)
    rows, text = [], words(rng, 90)
    for i in range(n):
        rows.append((1000 * seed + i, " ".join(text).capitalize() + "."))
        if rng.random() < 0.8:
            text = text.copy()
            text[rng.randrange(len(text))] = f"drift{i}"
        if rng.random() < 0.1:
            text = words(rng, rng.randint(1, 90))
    return rows


@pytest.mark.parametrize("block", [256, 3])
def test_links_and_classes(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", block)
    monkeypatch.setattr(jaccard, "BROADCAST_KEYS", 1_000 if block > 3 else 0)
    rows = odd_texts() + chains(1, 60) + chains(2, 60) + [(5000 + i, "same old words") for i in range(9)]
    rows += [(None, chains(1, 1)[0][1]), (5000, "same old words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(jaccard.join(docs)) == brute(rows)


def test_empty_table_and_other_columns(odd, no_docs):
    assert rows_of(jaccard.join(odd)) == brute(odd_texts())
    assert jaccard.join(no_docs).count() == 0
    assert jaccard.drop_near_copies(no_docs).count() == 0


def test_one_row_of_each_class_stays(odd):
    kept = jaccard.drop_near_copies(odd)
    assert kept.dtypes == odd.dtypes
    ids = [r[0] for r in kept.select("doc_id").collect()]
    classes = {}
    for doc_id, class_id, n in brute(odd_texts()):
        classes.setdefault((class_id, n > 0), []).append(doc_id)
    expected = []
    for (class_id, linked), members in classes.items():
        expected += [class_id] if linked else members
    assert sorted(ids, key=repr) == sorted(expected, key=repr)


def test_bands_reach_the_recall():
    for threshold, recall in ((0.8, 0.9999), (0.5, 0.9), (1.0, 0.99)):
        bands, rows = jaccard.bands_for(threshold, recall, 128)
        assert bands * rows <= 128 and 1 - (1 - threshold**rows) ** bands >= recall
    with pytest.raises(ValueError):
        jaccard.bands_for(0.1, 0.9999, 16)


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    edges += [(i, i + 1) for i in range(300, 400)] + [(500, i) for i in range(501, 560)]
    edges = [e for e in edges if e[0] != e[1]]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    named = [(b"%05d" % a, b"%05d" % b) for a, b in edges]
    df = spark.createDataFrame(named, "key binary, other binary")
    found = {int(bytes(r[0])): int(bytes(r[1])) for r in jaccard.components(df).collect()}
    assert found == {i: find(i) for i in list(root)}
