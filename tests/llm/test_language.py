"""Language profiles: accuracy on documents that were kept out, and odd texts."""

import zlib

from llm_fixtures import odd_texts

from sensorlake.llm import language


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = {r["doc_id"]: r for r in language.identified(docs).collect()}
    rows = docs.collect()
    assert len(rows) == len(found)
    for r in rows:
        assert found[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    out = [r for r in rows if found[r["doc_id"]]["held_out"] and r["lang"]]
    right = sum(found[r["doc_id"]]["lang_pred"] == r["lang"] for r in out)
    assert len(out) > 20 and right / len(out) > 0.95


def test_labels_of_kept_out_rows_do_not_matter(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    other = docs.selectExpr("doc_id", "text", "case when crc32(encode(cast(doc_id as string), 'utf-8')) % 5 = 0 then 'xx' else lang end as lang")
    a = language.identified(docs).orderBy("doc_id").collect()
    assert a == language.identified(other).orderBy("doc_id").collect()


def test_odd_texts(odd, no_docs):
    found = language.identified(odd).collect()
    assert len(found) == len(odd_texts())
    blank = {6, 7, 8, 9, 10}
    for r in found:
        assert 0 <= r["score"] <= 1
        if r["doc_id"] in blank:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert {r["lang_pred"] for r in found if r["doc_id"] in (1, 12)} == {"en"}
    assert language.identified(no_docs).count() == 0


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert language.identified(docs).first()["lang_pred"] == "und"


def test_trigram_vectors_bind_and_rotate():
    import numpy as np

    a, b, c = (language.letter_vectors(np.array([ord(x)], np.uint32))[0] for x in "abc")
    packed = np.array([(ord("a") << 42) | (ord("b") << 21) | ord("c")], np.uint64)
    expected = np.roll(a, 2) * np.roll(b, 1) * c
    assert (language.trigram_vectors(packed)[0] == expected).all()


def test_trigrams_of_a_text():
    import numpy as np

    texts = ["Ab c", "", "d"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.array([0, 4, 4, 5])
    owner, grams = language.text_trigrams(offsets, data)
    mask = (1 << 21) - 1
    shown = ["".join(chr(int(g) >> s & mask) for s in (42, 21, 0)) for g in grams]
    assert list(zip(owner.tolist(), shown)) == [
        (0, "\0ab"), (0, "ab\0"), (0, "\0c\0"), (2, "\0d\0"),
    ]
