"""The registered queries of the corpus operators, each with its SQL where there is one."""

import public_tokenizers
from pyspark.sql import functions as F

from sensorlake.llm import (
    bpe, exact_dedup, jaccard, language, negatives, pii, quality, secret_scan, token_counts,
    token_files, warc, whitening, winnow,
)

QUERIES = {}
SQL = {}


def query(sql=None):
    def add(build):
        QUERIES[build.__name__] = build
        if sql is not None:
            SQL[build.__name__] = sql
        return build

    return add


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op2_byte_bpe(spark, sf_dir):
    """Byte-level BPE ids of every document, decoded again."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents")
    return bpe.digests(bpe.with_tokens(docs, path, public_tokenizers.PATTERN))


_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP8_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(10, len(w)) AS k,
         array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
       FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i
             FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM iw),
dw AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS win
       FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
             FROM d, sizes WHERE len(w) >= k)),
hits AS (SELECT doc_id, i, dw.k, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.k = iw.k),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query(OP8_SQL)
def op8_decontaminate(spark, sf_dir):
    """Words of documents inside passages of the benchmark."""
    found = winnow.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return winnow.digests(found)


OP7_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
  CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d AND p.n >= 100
"""


@query(OP7_SQL)
def op7_warc(spark, sf_dir):
    """Every page as a WARC record, read back from the archives."""
    found = warc.read(warc.write(table(spark, sf_dir, "pages")))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op5_token_files(spark, sf_dir):
    """Ids of every document in binary files, read back."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_files.read(token_files.write(table(spark, sf_dir, "documents"), path))


def _op4_sql():
    """The counts, the votes, and the rounds of the estimation as a recursive query."""
    space, n = r"\x20\x09-\x0D", 9
    marks = r"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+"
    functions = ", ".join(f"'{w}'" for w in quality.FUNCTION_WORDS)
    repeated = f"""SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (
        SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (
          SELECT *, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS times FROM (
            SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d))
        WHERE times > 1) GROUP BY 1"""

    def vote(good, bad):
        return f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END"

    length = "(word_chars / greatest(n_words, 1))"
    votes = [
        vote("n_words >= 80", "n_words < 20"),
        vote(f"{length} BETWEEN 3.5 AND 8.0", f"{length} < 2.5 OR {length} > 12.0"),
        vote("50 * n_symbols < n_words", "10 * n_symbols > n_words"),
        vote("50 * n_bare < n_words", "10 * n_bare > n_words"),
        vote("n_function >= 3", "n_function = 0 AND n_words >= 30"),
        vote("10 * n_dup_lines <= n_breaks", "3 * n_dup_lines > n_breaks + 1"),
        vote("4 * n_repeat_words < n_words", "5 * n_repeat_words > 2 * n_words"),
        vote("10 * n_upper < word_chars", "2 * n_upper > word_chars"),
        vote("10 * n_marks < n_words", "2 * n_marks > n_words"),
    ]
    places = [(j, v) for j in range(n) for v in (-1, 0, 1)]

    def name(kind, j, v):
        return f"{kind}{j}_{v + 1}"

    def product(kind):
        return " * ".join(
            f"CASE v{j} WHEN 1 THEN {name(kind, j, 1)} WHEN 0 THEN {name(kind, j, 0)}"
            f" ELSE {name(kind, j, -1)} END"
            for j in range(n)
        )

    def bounded(x):
        return f"least({1 - quality.MARGIN}::DOUBLE, greatest({quality.MARGIN}::DOUBLE, {x}))"

    def start(kind, shares):
        return ", ".join(f"{shares[v + 1]}::DOUBLE AS {name(kind, j, v)}" for j, v in places)

    share = bounded("sum(n * p) / sum(n)")
    again = [
        bounded(f"sum(CASE WHEN v{j} = {v} THEN n * {w} ELSE 0 END) / ({s} * sum(n))")
        for w, s in (("p", share), ("(1 - p)", f"(1 - {share})"))
        for j, v in places
    ]
    p = f"share * {product('g')} / (share * {product('g')} + (1 - share) * {product('b')})"
    pattern = ", ".join(f"v{j}" for j in range(n))
    return rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^{space}]+') AS w FROM documents),
l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^{space}]'))
    AS lines FROM d),
r AS ({repeated}),
c AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    length(text) - length(replace(text, chr(10), '')) AS n_breaks,
    len(regexp_extract_all(text, '[A-Z]')) AS n_upper,
    len(regexp_extract_all(text, '[!?|]')) AS n_marks,
    len(list_filter(w, lambda x: regexp_full_match(x, '{marks}'))) AS n_bare,
    len(list_intersect(list_distinct(w), [{functions}])) AS n_function
  FROM d JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
v AS (SELECT *, {", ".join(f"{x} AS v{j}" for j, x in enumerate(votes))} FROM c),
pat AS (SELECT {pattern}, CAST(count(*) AS DOUBLE) AS n FROM v GROUP BY ALL),
em AS (SELECT 0 AS i, {quality.START_SHARE}::DOUBLE AS share, {start('g', quality.START_ON_GOOD)},
    {start('b', quality.START_ON_BAD)}
  UNION ALL SELECT i + 1, {share}, {", ".join(again)}
  FROM (SELECT *, {p} AS p FROM em, pat WHERE i < {quality.ROUNDS}) GROUP BY i),
j AS (SELECT v.*, {p} AS p, n_words < {quality.MIN_WORDS}
    OR 100 * n_repeat_words > {quality.MAX_REPEATED} * n_words AS base_failed
  FROM v, em WHERE i = {quality.ROUNDS})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND p >= {quality.KEEP} AS kept FROM j"""


@query(_op4_sql())
def op4_quality(spark, sf_dir):
    """Counts of every document and the verdict of the learned rules."""
    return quality.verdicts(table(spark, sf_dir, "documents")).drop("posterior", "votes")


OP6_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') AS w FROM documents),
c AS (SELECT array_to_string(w, ' ') AS t, any_value(w) AS w, count(*) AS n, min(doc_id) AS rep
      FROM d WHERE len(w) > 0 GROUP BY 1),
s AS (SELECT DISTINCT rep, n, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS g
      FROM (SELECT *, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM c)),
z AS (SELECT rep, count(*) AS size FROM s GROUP BY 1),
p AS (SELECT a.rep AS a, b.rep AS b, b.n AS n, count(*) AS shared
      FROM s a JOIN s b ON a.g = b.g AND a.rep <> b.rep GROUP BY ALL),
l AS (SELECT a, b, n FROM p JOIN z x ON x.rep = a JOIN z y ON y.rep = b
      WHERE 5 * shared >= 4 * (x.size + y.size - shared)),
r AS (SELECT rep AS a, rep AS b FROM c UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
m AS (SELECT a, min(b) AS class_id FROM r GROUP BY 1),
k AS (SELECT a, sum(n) AS n FROM l GROUP BY 1)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id,
  CAST(coalesce(c.n - 1 + coalesce(k.n, 0), 0) AS BIGINT) AS n_links
FROM d LEFT JOIN c ON array_to_string(d.w, ' ') = c.t
LEFT JOIN m ON m.a = c.rep LEFT JOIN k ON k.a = c.rep
"""


@query(OP6_SQL)
def op6_jaccard_join(spark, sf_dir):
    """Class and number of links of every document."""
    return jaccard.join(table(spark, sf_dir, "documents"))


@query()
def op9_secrets(spark, sf_dir):
    """Secrets of every document: known forms and random strings."""
    return secret_scan.digests(secret_scan.scan(table(spark, sf_dir, "documents")))


@query()
def op10_surrogates(spark, sf_dir):
    """Every document with surrogates for its personal data."""
    return pii.surrogates(table(spark, sf_dir, "documents"))


@query()
def op1_language(spark, sf_dir):
    """Language of every document."""
    return language.identified(table(spark, sf_dir, "documents"))


@query()
def op3_token_counts(spark, sf_dir):
    """Number of unigram tokens of every document."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.counted(table(spark, sf_dir, "documents"), path)


OP13_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)
"""


@query(OP13_SQL)
def op13_exact_dedup(spark, sf_dir):
    """The row that stays of every group of equal texts."""
    return exact_dedup.repeats(table(spark, sf_dir, "documents"))


@query()
def op12_whitening(spark, sf_dir):
    """Embeddings projected on the leading components of their covariance."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


OP11_SQL = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
    CAST(list_inner_product(a.x, r.x) AS BIGINT) AS score
  FROM r a JOIN r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
"""


@query(OP11_SQL)
def op11_hard_negatives(spark, sf_dir):
    """Rows of other labels in a window below the nearest rows of an anchor's own."""
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mined(rows.withColumn("label", moved), "vec_id % 100 = 0")
