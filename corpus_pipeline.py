"""From raw documents to token ids, stage by stage.

Each stage is a function of (spark, docs, sf_dir) that returns a DataFrame; it is written
as Parquet and read again as the next one's ``docs``. All but the last keep the columns
of their input.
"""

import public_tokenizers

from sensorlake.llm import bpe, jaccard, quality, secret_scan, winnow
from sensorlake.session import written


def quality_rules(spark, docs, sf_dir):
    """Documents that the learned rules reject go."""
    return quality.drop_poor(docs)


def near_copies(spark, docs, sf_dir):
    """One document of each group of near copies stays."""
    return jaccard.drop_near_copies(docs)


def decontaminated(spark, docs, sf_dir):
    """Documents with a passage of the benchmark go."""
    return winnow.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_redacted(spark, docs, sf_dir):
    """Secrets in the texts give way to a mark."""
    return secret_scan.redact(docs)


def token_ids(spark, docs, sf_dir):
    """Ids of each text, with digests of the ids and of the text decoded from them."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(bpe.with_tokens(docs, path, public_tokenizers.PATTERN), keep_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontaminated),
    ("secret scans", secrets_redacted),
    ("byte-level BPE encoding and decoding", token_ids),
]

#: Byte-level BPE has no SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
