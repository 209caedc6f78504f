import random

import pytest

KINDS = (
    "doc_id long, text string, lang string, source string, n_chars long, key string, row string, "
    "found string, counts int, votes int, text_ string, uid int, spans string, p double"
)
EXTRA = ("k", "r", "f", 1, 2, "t", 3, "s", 0.5)


def words(rng, n, vowels="aeiou"):
    return [
        "".join(rng.choice("bdklmnrst") + rng.choice(vowels) for _ in range(rng.randint(1, 4)))
        for _ in range(n)
    ]


def odd_texts():
    """Nulls, empty and blank texts, repeats, other scripts, marks, and a very long text."""
    rng = random.Random(5)
    base = words(rng, 120)
    near = base.copy()
    near[60] = "changed"
    text = " ".join(base) + ".\nThe end of the line.\nThe end of the line."
    return [
        (1, text), (1, text), (2, text), (3, " ".join(near)), (4, " ".join(base[:3])),
        (5, " ".join(base[:3]) + "!"), (6, None), (7, ""), (8, " \n\t "), (9, None), (10, "!!!"),
        (None, "no id at all " + " ".join(words(rng, 60))), (None, None),
        (11, "Größe, façade; naïve ÉTÉ 漢字かな交じり文 \U0001f600 ä ﬁ"),
        (12, " ".join(words(rng, 30_000))), (13, "x" * 5000), (14, "a\x00b c  d   e "),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with every defect and with columns that operators use themselves."""
    rows = [
        (i, t, "en" if n % 2 else None, None if n % 3 else "src", len(t) if t else None, *EXTRA)
        for n, (i, t) in enumerate(odd_texts())
    ]
    return spark.createDataFrame(rows, KINDS)


@pytest.fixture(scope="session")
def no_docs(odd):
    return odd.limit(0)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
