"""The stages one by one: what stays, what goes, and the columns."""

from base64 import b64decode

import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from llm_fixtures import KINDS, odd_texts, words
from test_jaccard import shingles
from test_winnow import brute as passages

TEXT_COLUMNS = KINDS.split(", ")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Clean, poor, copied, contaminated and secret documents, and a benchmark."""
    import random

    rng = random.Random(11)
    path = str(tmp_path_factory.mktemp("tables"))

    def prose(n):
        return " ".join(w if rng.random() < 0.7 else rng.choice(["the", "of", "and", "to"]) for w in words(rng, n))

    item = prose(30)
    rows = [(1000 + i, prose(120)) for i in range(60)]
    rows += [(1100 + i, " | ".join(words(rng, 80)) + " # # #") for i in range(8)]
    rows += [(1200 + i, rows[0][1] if i % 2 else rows[0][1] + " tail") for i in range(6)]
    rows += [(1300 + i, prose(60) + " " + item + " " + prose(20)) for i in range(4)]
    rows += [(1400, prose(80) + " password=hunter2secret and " + "0123456789abcdef" * 2), (1401, prose(90))]
    rows += odd_texts()
    extra = (None,) * (len(TEXT_COLUMNS) - 2)
    spark.createDataFrame([(*r, *extra) for r in rows], KINDS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(
        f"{path}/benchmark.parquet"
    )
    return path, dict(rows), item


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    """The rows before and after each stage."""
    out, docs = [], spark.read.parquet(f"{folder[0]}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, docs, folder[0])
        if k < 4:
            assert after.dtypes == docs.dtypes, name
        path = str(tmp_path_factory.mktemp("stages") / "rows")
        after.write.parquet(path)
        after = spark.read.parquet(path)
        out.append((docs.collect(), after.collect()))
        docs = after
    return out


def ids(rows):
    return {r["doc_id"] for r in rows}


def test_poor_documents_go(stages):
    before, after = stages[0]
    assert set(range(1000, 1060)) <= ids(after) and not set(range(1100, 1108)) & ids(after)
    assert {r for r in after if r["doc_id"] in range(1000, 1060)} <= set(before)


def test_one_of_each_group_stays(stages):
    before, after = stages[1]
    sets = {r["doc_id"]: shingles(r["text"]) for r in before}

    def similar(a, b):
        return len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])

    kept = [r["doc_id"] for r in after]
    assert len(kept) == len(set(kept)) and 1000 in kept and not set(range(1200, 1206)) & set(kept)
    for i in ids(before) - set(kept):
        assert any(similar(i, k) for k in kept)
    assert not any(similar(a, b) for a in kept for b in kept if (a or -1) < (b or -1))


def test_contaminated_documents_go(stages, folder):
    before, after = stages[2]
    hit = {r[0] for r in passages([(r["doc_id"], r["text"]) for r in before], [(1, folder[2])]) if r[5]}
    assert set(range(1300, 1304)) <= hit and ids(after) == ids(before) - hit


def test_secrets_are_replaced(stages):
    before, after = stages[3]
    texts = {r["doc_id"]: r["text"] for r in before}
    assert ids(before) == ids(after)
    for r in after:
        if r["doc_id"] == 1400:
            assert r["text"].count("[secret]") == 2 and "hunter2" not in r["text"]
        else:
            assert r["text"] == texts[r["doc_id"]]


def test_ids_are_those_of_the_library(stages):
    before, after = stages[4]
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    texts = {r["doc_id"]: r["text"] for r in before}
    assert ids(after) == ids(before)
    for r in after:
        assert list(r["ids"]) == library.encode_ordinary(texts[r["doc_id"]] or "")
        assert r["n_tokens"] == len(r["ids"])


def test_run_gives_the_last_stage(spark, folder, stages):
    found = corpus_pipeline.run(spark, folder[0])
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, stages[4][1]), key=repr)
