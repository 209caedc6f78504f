"""Surrogates for personal data: keyed, of the same type and format, and distinct.

Entities are e-mail addresses, phone numbers with a country code, long card-like numbers,
IPv4 addresses, and names after a title. A value gets the same surrogate wherever it
stands and however it is punctuated; the surrogate takes over the punctuation and case.

* Digits go through a keyed permutation of all numbers of that length, which keeps
  different values apart by its nature and leaves none where it was: a Feistel network
  over two halves, its rounds from SHA-256, a shift, and the network backwards. A phone
  number keeps its country code; a card its first digit, and the check digit is valid if
  it was; an address keeps its first byte and the places of leading zeros.
* Letters and digits of an e-mail address are drawn anew from a keyed hash; equal domains
  get equal surrogates, which end in the reserved ``.example``. From the second tweak on
  the local part grows, so that a domain whose short names are all in use has spare ones.
* A name becomes syllables of its own script (Latin, Greek, Cyrillic), with the ending of
  the gender that the title tells.

Two checks follow on the table of distinct values: no two of a type may have one
surrogate, and none may keep itself. Those that fail, but for the first of equals, get
the next ``tweak`` of the key, until none fails, however many rounds it takes: what can
fail grows with the tweak or has far more surrogates than values (cards). The tweaks, if
any, are joined to the rows again.

All of it is DataFrame functions. Null text stays null and has no entities. Repeated rows
get the same surrogates. An empty table gives no rows. Other columns are left out,
whatever their names.
"""

from pyspark.sql import functions as F

from sensorlake.llm.spans import let, matches
from sensorlake.session import written

KEY = "surrogates"
FEISTEL_ROUNDS = 6
#: Tweaks after which an e-mail address or a name grows by a letter.
MAIL_TWEAKS, NAME_TWEAKS = 2, 4

# The forms of entities, and titles by gender.
TITLES = {
    "f": "Mrs Ms Miss Frau Madame Mme Sra Señora Κυρία Κα г-жа Госпожа".split(),
    "m": "Mr Herr Monsieur Sr Señor Κύριος Κος г-н Господин".split(),
}
_TITLE = "|".join(t for titles in TITLES.values() for t in titles)
_BYTE = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
FORMS = {
    # possessive, as a repeated group would otherwise need the stack of a long text
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": rf"(?<![\d.])(?:{_BYTE}\.){{3}}{_BYTE}(?!\.?\d)",
    "phone": r"\+\d{1,3}(?:[ .-]?\(\d{1,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}"
    r"|[ .-]\d{1,4}(?:[ .-]\d{2,8}){1,3}|\d{6,12})(?!\d)",
    "card": r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)",
    "name": rf"(?<!\p{{L}})(?:{_TITLE})\.? \p{{Lu}}[\p{{Ll}}'-]+(?: \p{{Lu}}[\p{{Ll}}'-]+)?",
}
KINDS = tuple(FORMS)
ANY = "|".join(f"(?:{p})" for p in FORMS.values())
#: Consonants and vowels of each script, and the endings of women's and men's names.
SYLLABLES = {
    "latin": ("bdfgklmnprstv", "aeiou", "a", "n"),
    "greek": ("βγδζκλμνπρστ", "αειου", "α", "ς"),
    "cyrillic": ("бвгдзклмнпрст", "аеиоу", "а", "н"),
}


def kind_of(value):
    kind = F.lit("name")
    for k in KINDS[-2::-1]:
        kind = F.when(F.rlike(value, F.lit(f"^(?:{FORMS[k]})$")), k).otherwise(kind)
    return kind


def entities(text):
    """Array of (start, end, kind, value, id): the id is the same for all spellings."""

    def named(m):
        def told(kind):
            digits = F.regexp_replace(m["part"], r"\D", "")
            own = F.when(kind.isin("phone", "card"), digits).otherwise(F.lower(m["part"]))
            return F.struct(
                m["start"].alias("start"), m["end"].alias("end"), kind.alias("kind"),
                m["part"].alias("value"), own.alias("id"),
            )

        return let(kind_of(m["part"]), told)

    return F.transform(matches(F.coalesce(text, F.lit("")), ANY), named)


# Surrogates ----------------------------------------------------------------------------


def _number(key, *parts):
    """A number of 52 bits from a keyed hash."""
    text = F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("long")


def _permuted(a, b, most_a, most_b, salt, key):
    """(a, b) below (most_a, most_b), permuted, none where it was.

    With most_b of at least 2, the shift of b between the rounds and their inverse moves
    every pair. An inverse round is a round on swapped sides that takes away.
    """
    start = F.struct(
        a.cast("long").alias("a"), b.cast("long").alias("b"),
        most_a.cast("long").alias("most_a"), most_b.cast("long").alias("most_b"),
    )
    middle = FEISTEL_ROUNDS

    def turn(s, i):
        by = 1 + _number(key, salt, F.lit("shift")) % (s["most_b"] - 1)
        n = _number(key, salt, F.least(i, 2 * middle - i), s["b"])
        more = F.pmod(s["a"] + n * F.when(i < middle, 1).otherwise(-1), s["most_a"])
        return F.struct(
            F.when(i == middle, (s["b"] + by) % s["most_b"]).otherwise(s["b"]).alias("a"),
            F.when(i == middle, s["a"]).otherwise(more).alias("b"),
            s["most_b"].alias("most_a"), s["most_a"].alias("most_b"),
        )

    def sides(s):
        return F.struct(s["b"].alias("a"), s["a"].alias("b"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(2 * middle)), start, turn, sides)


def _digits(digits, salt, key):
    """At least two digits, permuted among all strings of that length."""
    n = F.char_length(digits)
    half = F.floor(n / 2).cast("int")

    def power(k):
        return F.rpad(F.lit("1"), k + 1, F.lit("0")).cast("long")

    left, right = F.substring(digits, F.lit(1), half), F.substring(digits, half + 1, n)
    done = _permuted(left, right, power(half), power(n - half), F.concat_ws("|", salt, n), key)
    return let(
        done,
        lambda d: F.concat(
            F.lpad(d["a"].cast("string"), half, F.lit("0")),
            F.lpad(d["b"].cast("string"), n - half, F.lit("0")),
        ),
    )


def _check_digit(digits):
    """The digit that makes ``digits`` and it a valid card number (Luhn)."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda c: c.cast("int"))
    doubled = F.transform(
        values, lambda v, i: F.when(i % 2 == 0, v * 2 - F.when(v > 4, 9).otherwise(0)).otherwise(v)
    )
    total = F.aggregate(doubled, F.lit(0), lambda s, v: s + v)
    return ((10 - total % 10) % 10).cast("string")


def _card(own, salt, key):
    n = F.char_length(own)
    first, middle = F.substring(own, 1, 1), F.substring(own, F.lit(2), n - 2)
    valid = _check_digit(F.substring(own, F.lit(1), n - 1)) == F.substring(own, n, F.lit(1))
    new = F.concat(first, _digits(middle, F.concat(salt, F.lit("|valid")), key))
    other = F.concat(first, _digits(F.substring(own, F.lit(2), n - 1), salt, key))
    return F.when(valid, let(new, lambda x: F.concat(x, _check_digit(x)))).otherwise(other)


def _address(own, salt, key):
    parts = F.split(own, r"\.")

    def told(p):
        # a byte with a leading zero stays one: ten values, and a form of its own
        zero = [F.rlike(F.get(p, i), F.lit(r"^0\d")) for i in (1, 2, 3)]
        most = [F.when(z, 10).otherwise(256) for z in zero]
        x = [F.get(p, i).cast("int") for i in (1, 2, 3)]
        form = [F.when(z, "0").otherwise("") for z in zero]
        done = _permuted(
            x[0], x[1] * most[2] + x[2], most[0], most[1] * most[2],
            F.concat_ws("|", salt, F.get(p, 0), *[m.cast("string") for m in most]), key,
        )

        def joined(d):
            new = (d["a"], F.floor(d["b"] / most[2]), d["b"] % most[2])
            return F.concat_ws(
                ".", F.get(p, 0), *[F.concat(f, y.cast("string")) for f, y in zip(form, new)]
            )

        return let(done, joined)

    return let(parts, told)


def _drawn(shape, salt, key):
    """``shape`` with its letters and digits drawn anew from a keyed hash."""
    hashed = F.sha2(F.concat_ws("|", F.lit(key), salt, shape), 256)

    def char(h):
        def one(c, i):
            at = (i * 2) % 62
            x = F.conv(F.substring(h, at + 1, F.lit(2)), 16, 10).cast("int") + F.floor(i / 31).cast("int")
            letter = F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), x % 26 + 1, F.lit(1))
            digit = (x % 10).cast("string")
            return F.when(F.rlike(c, F.lit("[a-z]")), letter).when(
                F.rlike(c, F.lit("[0-9]")), digit
            ).otherwise(c)

        return F.array_join(F.transform(F.split(shape, ""), one), "")

    return let(hashed, char)


def _mail(own, salt, tweak, key):
    local, domain = F.substring_index(own, "@", 1), F.substring_index(own, "@", -1)
    # the domain is drawn without the local part; the local part knows its domain
    names = F.regexp_replace(domain, r"\.[^.]*$", "")
    more = F.when(F.rlike(local, F.lit("[0-9]$")), "0").otherwise("a")
    local = F.concat(local, F.repeat(more, F.floor(tweak / MAIL_TWEAKS).cast("int")))
    return F.concat(
        _drawn(local, F.concat_ws("|", salt, domain), key),
        F.lit("@"), _drawn(names, F.concat(F.lit("domain|"), domain), key), F.lit(".example"),
    )


def _name(own, salt, tweak, key):
    """``own`` is the title and the name in lower case; only the name changes."""
    title = F.regexp_extract(own, r"^(\S+) ", 1)
    words = F.split(F.regexp_replace(own, r"^\S+ ", ""), " ")
    female = F.regexp_replace(title, r"\.$", "").isin(*[t.lower() for t in TITLES["f"]])

    def word(script):
        consonants, vowels, women, men = SYLLABLES[script]

        def one(w, place):
            hashed = F.sha2(F.concat_ws("|", F.lit(key), salt, place, own), 256)
            size = F.greatest(F.lit(4), F.char_length(w)) + F.floor(tweak / NAME_TWEAKS).cast("int")

            def char(h):
                def letter(i):
                    x = F.conv(F.substring(h, (i * 2) % 62 + 1, F.lit(2)), 16, 10).cast("int")
                    drawn = F.when(
                        i % 2 == 0, F.substring(F.lit(consonants), x % len(consonants) + 1, F.lit(1))
                    ).otherwise(F.substring(F.lit(vowels), x % len(vowels) + 1, F.lit(1)))
                    ending = F.when(female, women).otherwise(men)
                    return F.when((i == size - 1) & (place == 0), ending).otherwise(drawn)

                return F.array_join(F.transform(F.sequence(F.lit(0), size - 1), letter), "")

            return let(hashed, char)

        return F.concat_ws(" ", title, F.array_join(F.transform(words, one), " "))

    return (
        F.when(F.rlike(words[0], F.lit(r"^\p{IsCyrillic}")), word("cyrillic"))
        .when(F.rlike(words[0], F.lit(r"^\p{IsGreek}")), word("greek"))
        .otherwise(word("latin"))
    )


def surrogate(kind, own, tweak, key=KEY):
    """The surrogate of an entity, in the form of its id."""
    salt = F.concat_ws("|", kind, tweak.cast("string"))
    code = F.when(F.substring(own, 1, 1).isin("1", "7"), 1).otherwise(2)
    phone = F.concat(
        F.substring(own, F.lit(1), code),
        _digits(F.substring(own, code + 1, F.char_length(own)), salt, key),
    )
    return (
        F.when(kind == "email", _mail(own, salt, tweak, key))
        .when(kind == "ip", _address(own, salt, key))
        .when(kind == "phone", phone)
        .when(kind == "card", _card(own, salt, key))
        .otherwise(_name(own, salt, tweak, key))
    )


def respelled(kind, value, new):
    """The surrogate with the punctuation or case of the value."""
    start = F.struct(F.lit(0).alias("i"), F.lit("").alias("out"))

    def step(done, c):
        digit = F.rlike(c, F.lit(r"\d"))
        return F.struct(
            (done["i"] + digit.cast("int")).alias("i"),
            F.concat(
                done["out"],
                F.when(digit, F.substring(new, done["i"] + 1, F.lit(1))).otherwise(c),
            ).alias("out"),
        )

    punctuated = F.aggregate(F.split(value, ""), start, step, lambda done: done["out"])
    rest = F.regexp_replace(new, r"^\S+ ", "")
    named = F.concat(F.regexp_extract(value, r"^(\S+ )", 1), F.initcap(rest))
    cased = F.when(value == F.upper(value), F.upper(new)).otherwise(new)
    return (
        F.when(kind.isin("phone", "card"), punctuated)
        .when(kind == "name", named)
        .when(kind == "email", cased)
        .otherwise(new)
    )


# Checks --------------------------------------------------------------------------------


def tweaks(values, key=KEY):
    """(kind, id, tweak) of those of the distinct ``values`` (kind, id) that need a tweak."""
    values = values.distinct().withColumn("tweak", F.lit(0))
    while True:
        new = surrogate(F.col("kind"), F.col("id"), F.col("tweak"), key)
        drawn = written(values.withColumn("new", new), "surrogates")
        # the first of those with one surrogate may keep it, if it is not itself
        first = drawn.groupBy("kind", "new").agg(
            F.min("id").alias("first"), F.count(F.lit(1)).alias("n")
        )
        drawn = written(drawn.join(first, ["kind", "new"]), "entities")
        bad = (F.col("id") == F.col("new")) | ((F.col("n") > 1) & (F.col("id") != F.col("first")))
        if not drawn.where(bad).limit(1).count():
            return drawn.select("kind", "id", "tweak").where("tweak > 0")
        values = drawn.select("kind", "id", (F.col("tweak") + bad.cast("int")).alias("tweak"))


def replaced(rows, text, keep, key=KEY):
    """The columns ``keep`` of ``rows``, ``found`` (entities) and ``text`` with surrogates."""
    found = rows.select(
        *keep, F.monotonically_increasing_id().alias("uid"),
        text.alias("text"), entities(text).alias("found"),
    )
    found = written(found, "entities")
    each = found.select("uid", F.explode("found").alias("e")).select("uid", "e.kind", "e.id")
    tweaked = tweaks(each.select("kind", "id"), key)
    none = F.create_map().cast("map<string,int>")
    if tweaked.limit(1).count():
        by_row = each.join(tweaked, ["kind", "id"]).distinct().groupBy("uid").agg(
            F.map_from_entries(
                F.collect_list(F.struct(F.concat_ws("|", "kind", "id"), "tweak"))
            ).alias("tweaks")
        )
        found = found.join(by_row, "uid", "left").withColumn("tweaks", F.coalesce("tweaks", none))
    else:
        found = found.withColumn("tweaks", none)
    text = F.col("text")

    def new(e):
        own = F.concat_ws("|", e["kind"], e["id"])
        tweak = F.coalesce(F.element_at(F.col("tweaks"), own), F.lit(0))
        return respelled(e["kind"], e["value"], surrogate(e["kind"], e["id"], tweak, key))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(done, e):
        gap = F.substring(text, done["at"] + 1, e["start"] - done["at"])
        return F.struct(e["end"].alias("at"), F.concat(done["out"], F.array(gap, new(e))).alias("out"))

    def joined(done):
        rest = F.substring(text, done["at"] + 1, F.char_length(text))
        return F.array_join(F.concat(done["out"], F.array(rest)), "")

    changed = F.when(F.size("found") > 0, F.aggregate("found", start, step, joined)).otherwise(text)
    return found.select(*keep, "found", changed.alias("text"))


def surrogates(docs, key=KEY):
    """(doc_id, text with surrogates, numbers of entities by kind) of every row."""
    found = replaced(docs.select("doc_id", "text"), F.col("text"), ["doc_id"], key)
    counts = [
        F.size(F.filter("found", lambda e: e["kind"] == k)).cast("long").alias(f"n_{k}")
        for k in KINDS
    ]
    return found.select("doc_id", "text", *counts)
