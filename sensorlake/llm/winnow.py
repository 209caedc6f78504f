"""Benchmark decontamination by winnowing.

Documents and benchmark items are fingerprinted alike: of every ``window - k + 1``
consecutive k-gram hashes the smallest is kept, the rightmost of equal ones. A passage
of ``window`` words that both share spans one such run of hashes, so it leaves the same
fingerprint at the same place in both. Equal fingerprints are then extended word by word
in both directions, and a common span of at least ``window`` words makes its words hit.
Items of fewer words have no full run; each is looked up as a whole.

The fingerprints of the benchmark are joined to those of a document inside the scan of
the documents, so the documents are not shuffled. The benchmark goes out in blocks of a
measured size: one block and one pass if it is small, else several passes, each written
to the shared folder, over the same rows.

Null text has no words. A text or item without words is never hit. Repeated rows are
judged each by itself. Items without id make words hit but are not listed; equal ids
count once. An empty benchmark leaves every document clean.
"""

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sensorlake.llm.words import Words, grams, text_slices, whole
from sensorlake.session import written

WINDOW = 10
GRAM = 5
#: Text of the benchmark that goes out at once, in bytes.
BLOCK_BYTES = 32 << 20

_FOUND = (
    "struct<n_words:bigint,spans:array<struct<first:int,last:int>>,items:array<bigint>>"
)


def fingerprints(hashes, rows, k, run):
    """Places of the smallest of each ``run`` consecutive k-grams, and all gram hashes."""
    gram = grams(hashes, k)
    n = len(gram) - run + 1
    inside = whole(rows, k + run - 1)
    if n <= 0 or not inside.any():
        return np.zeros(0, np.int64), gram
    # rightmost first, as argmin takes the first of equal ones
    stacked = np.stack([gram[j : j + n] for j in range(run - 1, -1, -1)])
    place = np.arange(n) + run - 1 - stacked.argmin(axis=0)
    return np.unique(place[inside[:n]]), gram


class Index:
    """Fingerprints of benchmark texts, and their words for the extension."""

    def __init__(self, items, window=WINDOW, k=GRAM):
        """``items``: pairs of id and text; equal texts are kept once."""
        self.window, self.k = window, k
        owners = defaultdict(set)
        for item, text in items:
            owners[text or ""].add(item)
        texts = sorted(owners)
        self.words, self.hashes, self.owners = [], [], []
        places, self.short = defaultdict(list), defaultdict(lambda: defaultdict(list))
        for row, offsets, data in text_slices(pa.array(texts, pa.string())):
            w = Words(offsets, data)
            for i in np.flatnonzero(w.counts()):
                lo, hi = w.first[i], w.first[i + 1]
                text, hashes = len(self.words), w.hash[lo:hi]
                self.words.append([w.word(j) for j in range(lo, hi)])
                self.hashes.append(hashes)
                self.owners.append(sorted(x for x in owners[texts[row + i]] if x is not None))
                if hi - lo < window:
                    self.short[hi - lo][int(grams(hashes, hi - lo)[0])].append(text)
                    continue
                one = np.zeros(hi - lo, np.int64)
                found, gram = fingerprints(hashes, one, k, window - k + 1)
                for q in found:
                    places[int(gram[q])].append((text, int(q)))
        self.places = dict(places)
        self.short = {k: dict(v) for k, v in self.short.items()}
        self.known = np.sort(np.array(list(places), np.uint64))

    def spans(self, w):
        """(first word, word after the last, text) of the common spans in some texts."""
        found = []
        place, gram = fingerprints(w.hash, w.row, self.k, self.window - self.k + 1)
        for p in place[_among(gram[place], self.known)]:
            for text, q in self.places[int(gram[p])]:
                found.append((int(p), text, q))
        out, done = [], {}
        for p, text, q in sorted(found):
            row = w.row[p]
            if done.get((row, text, p - q), -1) > p:
                continue  # on the same diagonal, inside a span that is known
            first, last = self._extended(w, p, text, q)
            done[row, text, p - q] = last
            if last - first >= self.window:
                out.append((first, last, text))
        for k, texts in self.short.items():
            gram, inside = w.grams(k)
            known = np.sort(np.array(list(texts), np.uint64))
            for p in np.flatnonzero(inside & _among(gram, known)):
                for text in texts[int(gram[p])]:
                    if all(w.word(p + j) == x for j, x in enumerate(self.words[text])):
                        out.append((int(p), int(p) + k, text))
        return out

    def _extended(self, w, p, text, q):
        words, hashes = self.words[text], self.hashes[text]
        lo, hi = w.first[w.row[p]], w.first[w.row[p] + 1]

        def same(i, j):
            return w.hash[i] == hashes[j] and w.word(i) == words[j]

        first, j = p, q
        while first > lo and j > 0 and same(first - 1, j - 1):
            first, j = first - 1, j - 1
        last, j = p, q
        while last < hi and j < len(words) and same(last, j):
            last, j = last + 1, j + 1
        return int(first), int(last)


def _among(values, known):
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def scanned(texts, index):
    """For an Arrow array of texts: words, spans that are hit, items that hit them."""
    n_words, counts, firsts, lasts, items, n_items = [], [], [], [], [], []
    for _, offsets, data in text_slices(texts):
        w = Words(offsets, data)
        n_words.append(w.counts())
        spans, owners = defaultdict(list), defaultdict(set)
        for first, last, text in index.spans(w):
            row = int(w.row[first])
            base = int(w.first[row])
            spans[row].append((first - base, last - base))
            owners[row].update(index.owners[text])
        for row in range(len(offsets) - 1):
            joined = _joined(spans[row]) if row in spans else []
            counts.append(len(joined))
            firsts += [a for a, _ in joined]
            lasts += [b for _, b in joined]
            own = sorted(owners[row]) if row in owners else []
            n_items.append(len(own))
            items += own
    span = pa.StructArray.from_arrays(
        [pa.array(firsts, pa.int32()), pa.array(lasts, pa.int32())], ["first", "last"]
    )
    words = np.concatenate(n_words) if n_words else np.zeros(0, np.int64)
    return pa.StructArray.from_arrays(
        [
            pa.array(words, pa.int64()),
            pa.ListArray.from_arrays(_ends(counts), span),
            pa.ListArray.from_arrays(_ends(n_items), pa.array(items, pa.int64())),
        ],
        ["n_words", "spans", "items"],
    )


def _ends(counts):
    return pa.array(np.concatenate([[0], np.cumsum(np.array(counts, np.int64))]), pa.int32())


def _joined(spans):
    """Spans that overlap or touch as one."""
    out = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def _blocks(items, block_bytes):
    """How many blocks hold the benchmark, by its measured size."""
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    return max(1, -(-int(size) // block_bytes))


def with_hits(docs, items, text="text", name="found", block_bytes=BLOCK_BYTES):
    """``docs`` with a struct column: n_words, spans of hit words, ids of hit items."""
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text"))
    blocks = _blocks(items, block_bytes)
    part = F.pmod(F.xxhash64("text"), F.lit(blocks))
    for b in range(blocks):
        some = items if blocks == 1 else items.where(part == b)
        index = spark.sparkContext.broadcast(Index([(r[0], r[1]) for r in some.toLocalIterator()]))
        found = _scan_udf(index)(F.col(text))
        if b == 0:
            docs = docs.withColumn(name, found)
        else:
            docs = docs.withColumn(name, _both(F.col(name), found))
        if b < blocks - 1:
            docs = written(docs, "hits")
    return docs


def _scan_udf(index):
    @F.arrow_udf(_FOUND)
    def found(texts: pa.Array) -> pa.Array:
        return scanned(texts, index.value)

    return found


def _both(old, new):
    """Hits of two blocks; spans are sorted and joined again."""

    def step(done, span):
        last = F.element_at(done, -1)
        apart = (F.size(done) == 0) | (F.try_element_at(done, F.lit(-1))["last"] < span["first"])
        grown = F.struct(
            last["first"].alias("first"), F.greatest(last["last"], span["last"]).alias("last")
        )
        return F.when(apart, F.concat(done, F.array(span))).otherwise(
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown))
        )

    empty = F.array().cast("array<struct<first:int,last:int>>")
    spans = F.array_sort(F.concat(old["spans"], new["spans"]))
    return F.struct(
        old["n_words"].alias("n_words"),
        F.aggregate(spans, empty, step).alias("spans"),
        F.array_sort(F.array_union(old["items"], new["items"])).alias("items"),
    )


def scan(docs, items, block_bytes=BLOCK_BYTES):
    """(doc_id, n_words, n_hit, spans, items) of every row."""
    found = with_hits(docs.select("doc_id", "text"), items, block_bytes=block_bytes)
    n_hit = F.aggregate(
        "found.spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"]
    )
    return found.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.col("found.spans").alias("spans"),
        F.col("found.items").alias("items"),
    )


def digests(found):
    """Rows of ``scan`` with counts and a digest in place of spans and ids."""
    ids = F.array_sort(F.col("items").cast("array<string>"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs, items):
    """``docs`` without the rows that hold a passage of the benchmark."""
    rows = docs.select(F.struct("*").alias("row"))
    found = with_hits(rows, items, text="row.text")
    return found.where(F.size("found.spans") == 0).select("row.*")
