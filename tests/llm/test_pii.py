"""Surrogates: nothing left, the same form, distinct and the same everywhere."""

import random
import re

import pytest
from llm_fixtures import odd_texts, rows_of, words
from pyspark.sql import functions as F

from sensorlake.llm import pii


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def valid_card(rng):
    head = "4" + "".join(rng.choices("0123456789", k=14))
    return next(head + c for c in "0123456789" if luhn(head + c))


def values(seed, n=60):
    rng = random.Random(seed)
    out = {"email": set(), "ip": set(), "phone": set(), "card": set(), "name": set()}
    for _ in range(n):
        out["email"].add(f"{words(rng, 1)[0]}.{rng.randint(1, 99)}@mail{rng.randint(1, 3)}.example.com")
        out["ip"].add(".".join(str(rng.randint(0, 255)) for _ in range(4)))
        out["phone"].add(f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(0, 9999):04d}")
        out["card"].add(valid_card(rng))
        out["name"].add(f"{rng.choice(['Mr', 'Mrs', 'Frau', 'Herr'])} {words(rng, 1)[0].capitalize()}")
    return {k: sorted(v) for k, v in out.items()}


def test_surrogates(spark):
    rng, own = random.Random(1), values(2)
    rows, parts = [], []
    for i in range(100):
        kind = rng.choice(list(own))
        value = rng.choice(own[kind])
        parts.append((kind, value))
        rows.append((i, f"{words(rng, 3)[0]} é {value}, and again {value}."))
    found = pii.surrogates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    seen = {}
    for r in sorted(found, key=lambda r: r["doc_id"]):
        kind, value = parts[r["doc_id"]]
        head = rows[r["doc_id"]][1].split(" ")[0]
        got = re.fullmatch(rf"{head} é (.+), and again (.+)\.", r["text"])
        assert got[1] == got[2] and value not in r["text"] and r[f"n_{kind}"] == 2
        assert seen.setdefault((kind, value), got[1]) == got[1]
        if kind in ("phone", "card"):
            assert re.sub(r"\d", "0", got[1]) == re.sub(r"\d", "0", value)
        if kind == "card":
            assert luhn(got[1]) and got[1][0] == value[0]
        if kind == "phone":
            assert got[1][:3] == "+1 "
        if kind == "ip":
            assert got[1].split(".")[0] == value.split(".")[0]
            assert all(0 <= int(b) < 256 for b in got[1].split("."))
        if kind == "email":
            assert got[1].endswith(".example")
        if kind == "name":
            title, name = got[1].split(" ")
            assert title == value.split(" ")[0] and name.istitle()
            assert name[-1] == ("a" if title in ("Mrs", "Frau") else "n")
    new = [(k, s) for (k, _), s in seen.items()]
    assert len(set(new)) == len(new)


def test_digits_are_permuted(spark):
    """Every string of three digits is the surrogate of exactly one."""
    df = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    new = [r[0] for r in df.select(pii._digits(F.col("d"), F.lit("salt"), "key")).collect()]
    assert sorted(new) == [f"{i:03d}" for i in range(1000)]
    other = [r[0] for r in df.select(pii._digits(F.col("d"), F.lit("salt"), "other")).collect()]
    assert new != other


def test_one_value_in_many_spellings(spark):
    rows = [(1, "+1 (988) 555-2485 +19885552485 4111 1111 1111 1111 4111111111111111 A.b@C.org a.b@c.org")]
    text = pii.surrogates(spark.createDataFrame(rows, "doc_id long, text string")).first()["text"]
    got = re.fullmatch(r"(\+1 \(\d{3}\) \d{3}-\d{4}) (\+\d{11}) ((?:\d{4} ?){4}) (\d{16}) (\S+) (\S+)", text)
    assert re.sub(r"\D", "", got[1]) == got[2][1:] and got[3].replace(" ", "") == got[4]
    assert got[5].lower() == got[6].lower()


def test_scripts_and_unknown_values(spark):
    rows = [(1, "г-жа Анна Иванова и г-н Пётр"), (2, "Κύριος Νίκος"), (3, "1.2.3 300.1.1.1 a@b 12345")]
    found = {r["doc_id"]: r["text"] for r in pii.surrogates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert re.fullmatch(r"г-жа [А-я]+а [А-я]+ и г-н [А-я]+н", found[1]) and "Анна" not in found[1]
    assert re.fullmatch(r"Κύριος [Α-ω]+ς", found[2]) and "Νίκος" not in found[2]
    assert found[3] == rows[2][1]


def test_equal_surrogates_are_tweaked(spark, monkeypatch):
    """With hardly any syllables names collide at first, and are distinct in the end."""
    monkeypatch.setitem(pii.SYLLABLES, "latin", ("bd", "ae", "a", "n"))
    names = sorted({f"mr {w}" for w in words(random.Random(3), 60)})
    rows = [(i, f"Mr {n[3:].capitalize()} came") for i, n in enumerate(names)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [r["text"] for r in pii.surrogates(docs).collect()]
    assert len(set(found)) == len(names)
    assert not set(found) & {t for _, t in rows}
    tweaked = pii.tweaks(spark.createDataFrame([("name", n) for n in names], "kind string, id string"))
    assert tweaked.count() > 0


def test_odd_texts(odd, no_docs):
    found = pii.surrogates(odd)
    assert rows_of(found.select("doc_id", "text")) == sorted(odd_texts(), key=repr)
    assert pii.surrogates(no_docs).count() == 0


def test_long_values(spark):
    texts = ["x@" + "a." * 60_000 + "a", "1" * 100_000, "+1" + " 22" * 50_000, "1.2." * 50_000]
    rows = list(enumerate(texts))
    found = pii.surrogates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["n_email"] for r in found} == {0: 1, 1: 0, 2: 0, 3: 0}


@pytest.mark.parametrize("value,kind", [
    ("a.b+c@d-e.co.uk", "email"), ("255.0.0.1", "ip"), ("+49 30 1234567", "phone"),
    ("4111-1111-1111-1111", "card"), ("Mme Élise Dupont", "name"),
])
def test_kinds(spark, value, kind):
    df = spark.createDataFrame([(f"x {value}, y",)], "t string")
    found = df.select(F.explode(pii.entities(F.col("t")))).select("col.*").collect()
    assert [(r["kind"], r["value"]) for r in found] == [(kind, value)]


def test_all_short_names_of_a_domain(spark):
    """Values that use up all of their form get surrogates of their own nevertheless."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    mails = [f"{c}@test.com" for c in letters]
    # nothing to draw in the local part, and more domains than one letter tells apart
    mails += [f"___@{c}.{end}" for c in letters for end in ("com", "org")]
    found = spark.createDataFrame([("email", m) for m in mails], "kind string, id string")
    tweaked = {r["id"]: r["tweak"] for r in pii.tweaks(found).collect()}
    both = spark.createDataFrame([(m, tweaked.get(m, 0)) for m in mails], "id string, tweak int")
    rows = both.select("id", pii.surrogate(F.lit("email"), F.col("id"), F.col("tweak"))).collect()
    new = {r[0]: r[1] for r in rows}
    assert len(set(new.values())) == len(mails) and not set(new.values()) & set(mails)
    assert all(re.fullmatch(r"([a-z]+@[a-z]{4}|___[a-z]*@[a-z])\.example", x) for x in new.values())
    assert len({x.split("@")[1] for m, x in new.items() if m.endswith("@test.com")}) == 1


def test_all_numbers_of_a_form(spark):
    """All numbers of a form are permuted, none stays, and no tweak is needed."""
    for key in ("a", "b", "c"):
        own = [("phone", f"21{i:02d}") for i in range(100)]
        own += [("ip", f"9.{a}.0{b}.0{c}") for a in ("01", "1") for b in range(10) for c in range(10)]
        df = spark.createDataFrame(own, "kind string, id string")
        new = df.select("kind", "id", pii.surrogate(F.col("kind"), F.col("id"), F.lit(0), key)).collect()
        assert len({(r[0], r[2]) for r in new}) == len(own) and all(r[1] != r[2] for r in new)
        assert sorted(r[2] for r in new if r[0] == "phone") == [f"21{i:02d}" for i in range(100)]
        assert all(re.fullmatch(r"9\.\d+\.0\d\.0\d", r[2]) for r in new if r[0] == "ip")
        assert pii.tweaks(df, key).count() == 0
