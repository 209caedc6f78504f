"""Secrets in texts: known forms, and strings that look random.

Base spans have a known form: an assignment to a telling name, an access key, a long
run of hex digits. Beyond them every long token is a candidate. Its encoding is inferred
from its characters (decimal, hex, base32, letters and digits of one case or of both,
base64), which gives an alphabet, and three tests look at it. Each asks how likely text
written in that encoding would look as random as the token does (``ENCODINGS`` has what is
assumed of such text), and gives a p-value:

* chi-squared over the alphabet. Two symbols of text agree with probability ``repeat`` at
  least, so the statistic grows with the length. How far it lies below that counts.
* runs. Text goes on with letters of one case, or with digits, and changes between them at
  a share ``change`` of its places at most; numbers change between low and high digits.
  Chernoff's bound for more changes counts. Letters of one case have no such runs.
* serial correlation. In text vowels and consonants take turns: around a usual share of
  vowels, neighbours correlate below ``TURNS``. Numbers repeat and count up: the values of
  their neighbours correlate above ``ALIKE``. How far the token is beyond counts.

Fisher's method combines them. A token that is not random by one of the tests (more than
``MOST_OFF`` standard deviations off) gets the p-value 1, such as an alphabet in order.

Short tokens cannot reach small p-values, and many words are written in some encodings and
lengths and hardly any in others. So the step-up procedure of Benjamini and Hochberg goes by
class of encoding and length, over the distinct tokens: of those it adds in a class, a share
of ``FALSE_SHARE`` at most is expected to be text, and copies of a token count once. It needs
only counts by class and p-value, which are rounded up to a fixed grid: a table of bounded
size. Tokens are told apart by a hash of 64 bits, for counting only.

All of it is DataFrame functions. Null text counts as empty and has no spans. Positions
are code points, the end exclusive. Repeated rows are scanned each by itself. Without
candidates nothing is added. An empty table gives no rows.
"""

import string

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlake.llm.spans import before, let, matches, substituted
from sensorlake.session import written

# The base forms and the least lengths.
ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS, HEX = r"AKIA[A-Z0-9]{16,}", r"(?<![0-9a-f])[0-9a-f]{24,}"
ASSIGN_LENGTH = 6
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}"
FALSE_SHARE = 0.05
#: Standard deviations by which a random token may be off in a test.
MOST_OFF = 3.0
#: Steps of the grid of p-values per unit of their logarithm, and how many steps there are.
STEPS, MOST_STEPS = 10, 4000
#: Where the classes of length begin.
LENGTHS = (16, 20, 24, 32, 40, 64)

VOWELS, VOWEL_SHARE = "aeiouAEIOU", 0.4
TURNS, ALIKE = -0.2, 0.3

_UPPER, _LOWER, _DIGITS = string.ascii_uppercase, string.ascii_lowercase, string.digits
_LETTERS = _UPPER + _LOWER
#: Pattern and alphabet of the encodings, the first that fits counts, and what is assumed of
#: text in them: ``repeat`` and ``change`` (None where runs tell nothing).
ENCODINGS = (
    (r"[0-9]+", _DIGITS, 0.25, 0.35),
    (r"[0-9a-f]+", _DIGITS + "abcdef", 0.15, 0.15),
    (r"[0-9A-F]+", _DIGITS + "ABCDEF", 0.15, 0.15),
    (r"[a-z]+", _LOWER, 0.0667, None),
    (r"[A-Z]+", _UPPER, 0.0667, None),
    (r"[A-Z2-7]+", _UPPER + "234567", 0.0667, 0.15),
    (r"[A-Z0-9]+", _UPPER + _DIGITS, 0.0667, 0.15),
    (r"[a-z0-9]+", _LOWER + _DIGITS, 0.0667, 0.15),
    (r"[A-Za-z]+", _LETTERS, 0.0667, 0.35),
    (r"[A-Za-z0-9]+", _LETTERS + _DIGITS, 0.0667, 0.35),
    (r"[A-Za-z0-9_-]+", _LETTERS + _DIGITS + "-_", 0.0667, 0.4),
    (r".+", _LETTERS + _DIGITS + "+/-_", 0.0667, 0.4),
)
#: The first of them are numbers, of which the very first have digits only.
NUMBERS, DECIMALS = 3, 1


def _spans(text, kind, pattern, group=0, least=0):
    found = F.filter(matches(text, pattern, group), lambda m: F.char_length(m["part"]) >= least)
    number = KINDS.index(kind)
    return F.transform(
        found,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(number).alias("kind"), m["end"].alias("end")
        ),
    )


#: Kind, pattern, group and least length of the known forms.
FORMS = (
    ("assign", ASSIGN, 1, ASSIGN_LENGTH),
    ("access", ACCESS, 0, 0),
    ("hex", HEX, 0, 0),
)


def _of_encoding(number, values):
    """The entry for an encoding of a list with one for each."""
    return F.get(F.array(*[F.lit(v) for v in values]), number)


def encoding(token):
    """The number of the first encoding that fits."""
    fits = F.lit(len(ENCODINGS) - 1)
    for i in range(len(ENCODINGS) - 2, -1, -1):
        fits = F.when(F.rlike(token, F.lit(f"^{ENCODINGS[i][0]}$")), i).otherwise(fits)
    return fits


def _tested(token, e):
    """The step of a token's p-value on the grid, rounded towards 1, by its encoding."""
    alphabet = _of_encoding(e, [x[1] for x in ENCODINGS])
    repeat = _of_encoding(e, [x[2] for x in ENCODINGS])
    change = _of_encoding(e, [x[3] if x[3] is not None else 1.0 for x in ENCODINGS])
    known = F.struct(
        F.char_length(token).cast("double").alias("n"), alphabet.alias("alphabet"),
        F.char_length(alphabet).cast("double").alias("a"),
        repeat.alias("repeat"), change.alias("change"), F.split(token, "").alias("chars"),
    )

    def tests(k):
        n, a = k["n"], k["a"]
        squares = F.aggregate(
            F.split(k["alphabet"], ""),
            F.lit(0.0),
            lambda s, c: s + F.pow(n - F.char_length(F.replace(token, c, F.lit(""))), F.lit(2)),
        )
        places = F.transform(k["chars"], lambda c: F.instr(k["alphabet"], c).cast("double"))
        return F.struct((squares * a / n - n).alias("chi"), places.alias("x"))

    def combined(k, t):
        n, a, chi = k["n"], k["a"], t["chi"]
        as_random = (chi - (a - 1)) / F.sqrt(2 * (a - 1))
        expected = a * (1 + (n - 1) * k["repeat"]) - n
        spread = F.sqrt(2 * (a - 1) + 4 * n * (a * k["repeat"] - 1))
        total = _tail((expected - chi) / spread) + _many_changes(k, e, t["x"]) + _neighbours(k, e, t["x"])
        # Fisher: twice the sum is chi-squared with twice as many degrees of freedom as tests
        log = let(
            total,
            lambda s: s - F.log(1 + s + F.when(k["change"] < 1, s * s / 2).otherwise(F.lit(0.0))),
        )
        random = (
            (as_random <= MOST_OFF)
            & (F.abs(_runs(t["x"], a)) <= MOST_OFF)
            & (F.abs(_serial(t["x"])) <= MOST_OFF)
        )
        step = F.least(F.lit(MOST_STEPS), F.floor(log * STEPS)).cast("int")
        return F.when(random, step).otherwise(F.lit(0))

    return let(known, lambda k: let(tests(k), lambda t: combined(k, t)))


def _tail(z):
    """Minus the logarithm of a bound of the normal distribution above z, at least 0."""
    return F.when(z > 0, 0.6931 + z * z / 2).otherwise(F.lit(0.0))


def _many_changes(k, e, x):
    """Minus the logarithm of the p-value of the changes between kinds of symbols."""
    kinds = F.when(
        e < DECIMALS, F.transform(x, lambda v: (v > k["a"] / 2).cast("int"))
    ).otherwise(
        F.transform(
            k["chars"],
            lambda c: F.when(c.between("0", "9"), 0).when(c.between("A", "Z"), 1)
            .when(c.between("a", "z"), 2).otherwise(3),
        )
    )

    def bound(h):
        pairs = F.sequence(F.lit(1), F.size(h) - 1)
        changes = F.aggregate(
            pairs, F.lit(0.0), lambda s, i: s + (F.get(h, i) != F.get(h, i - 1)).cast("int")
        )
        rate = changes / (k["n"] - 1)
        rest = F.when(rate < 1, (1 - rate) * F.log((1 - rate) / (1 - k["change"]))).otherwise(0.0)
        return F.when(
            rate > k["change"], (k["n"] - 1) * (rate * F.log(rate / k["change"]) + rest)
        ).otherwise(F.lit(0.0))

    return F.when(k["change"] < 1, let(kinds, bound)).otherwise(F.lit(0.0))


def _neighbours(k, e, x):
    """Minus the logarithm of the p-value of the serial correlation."""
    vowel = F.transform(
        k["chars"], lambda c: F.instr(F.lit(VOWELS), c).cast("boolean").cast("double") - VOWEL_SHARE
    )

    def turns(v):
        both = F.aggregate(
            F.sequence(F.lit(1), F.size(v) - 1),
            F.lit(0.0),
            lambda s, i: s + F.get(v, i) * F.get(v, i - 1),
        )
        return both / (VOWEL_SHARE * (1 - VOWEL_SHARE) * (k["n"] - 1))

    root = F.sqrt(k["n"])
    return F.when(e < NUMBERS, _tail(ALIKE * root - _serial(x))).otherwise(
        _tail((let(vowel, turns) - TURNS) * root)
    )


def _runs(x, a):
    """Standard deviations by which the number of runs is off."""
    high = F.transform(x, lambda v: (v > a / 2).cast("int"))

    def off(h):
        n = F.size(h).cast("double")
        n1 = F.aggregate(h, F.lit(0.0), lambda s, v: s + v)
        changes = F.aggregate(
            F.sequence(F.lit(1), F.size(h) - 1),
            F.lit(0.0),
            lambda s, i: s + F.abs(F.get(h, i) - F.get(h, i - 1)),
        )
        mean = 1 + 2 * n1 * (n - n1) / n
        spread = F.sqrt((mean - 1) * (mean - 2) / (n - 1))
        # all on one side: no runs to count, far from random
        return F.when(mean > 2, (1 + changes - mean) / spread).otherwise(F.lit(99.0))

    return let(high, off)


def _serial(x):
    """Standard deviations by which the correlation of neighbours is off."""
    n = F.size(x).cast("double")
    mean = F.aggregate(x, F.lit(0.0), lambda s, v: s + v) / n

    def off(m):
        both = F.aggregate(
            F.sequence(F.lit(1), F.size(x) - 1),
            F.lit(0.0),
            lambda s, i: s + (F.get(x, i) - m) * (F.get(x, i - 1) - m),
        )
        own = F.aggregate(x, F.lit(0.0), lambda s, v: s + (v - m) * (v - m))
        return F.when(own > 0, both / own * F.sqrt(n)).otherwise(F.lit(99.0))

    return let(mean, off)


def _class(e, n):
    """The number of the class of encoding and length."""
    return (e * len(LENGTHS) + sum((n >= at).cast("int") for at in LENGTHS) - 1).cast("int")


def _ordered(base, tokens):
    """Base spans and matches of long tokens by start; only the latter have a token."""

    def row(start, kind, end, token):
        return F.struct(
            start.alias("start"), kind.alias("kind"), end.alias("end"), token.alias("token")
        )

    number = F.lit(KINDS.index("random"))
    tokens = F.transform(tokens, lambda m: row(m["start"], number, m["end"], m["part"]))
    known = F.transform(
        base, lambda b: row(b["start"], b["kind"], b["end"], F.lit(None).cast("string"))
    )
    return F.array_sort(F.concat(known, tokens))


def _free(both, last, ahead):
    """The tokens of ``_ordered`` that no base span touches: the ones before end by their
    start, and the next one begins after them."""
    known = F.struct(both.alias("both"), last.alias("last"), ahead.alias("ahead"))
    return let(
        known,
        lambda k: F.filter(
            k["both"],
            lambda s, i: s["token"].isNotNull()
            & (F.get(k["last"], i) <= s["start"]) & (F.get(k["ahead"], i) >= s["end"]),
        ),
    )


def _candidate(s):
    return let(
        encoding(s["token"]),
        lambda e: F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
            _tested(s["token"], e).alias("step"),
            _class(e, F.char_length(s["token"])).alias("class"),
            F.xxhash64(s["token"]).alias("token"),
        ),
    )


def candidates(rows, text):
    """``rows`` with ``base`` and ``candidates``: arrays of (start, kind number, end, step,
    class, token as a hash) of long tokens outside the base spans."""
    far = (1 << 31) - 1
    for kind, pattern, group, least in FORMS:
        rows = rows.withColumn(f"_{kind}", _spans(text, kind, pattern, group, least))
    base = F.array_sort(F.concat(*[f"_{form[0]}" for form in FORMS]))
    rows = rows.withColumn("_tokens", matches(text, CANDIDATE)).withColumn("base", base)
    rows = rows.withColumn("_both", _ordered(F.col("base"), F.col("_tokens")))

    def of_base(field, other):
        return F.transform(
            "_both", lambda s: F.when(s["token"].isNull(), s[field]).otherwise(F.lit(other))
        )

    ahead = before(F.reverse(of_base("start", far)), F.least, far)
    rows = rows.withColumn("_last", before(of_base("end", 0), F.greatest, 0))
    rows = rows.withColumn("_ahead", F.reverse(ahead))
    free = _free(F.col("_both"), F.col("_last"), F.col("_ahead"))
    return rows.withColumn("candidates", F.transform(free, _candidate)).drop(
        *[f"_{form[0]}" for form in FORMS], "_tokens", "_both", "_last", "_ahead"
    )


def least_steps(tokens, false_share=FALSE_SHARE):
    """For each class the lowest step that the step-up procedure accepts, as an array.

    ``tokens`` has the columns class, step and token. The step s stands for p-values up to
    exp(-s / STEPS); k of the m distinct tokens of the class have one that small.
    """
    counted = tokens.distinct().groupBy("class", "step").agg(F.count(F.lit(1)).alias("n"))
    down = W.partitionBy("class").orderBy(F.desc("step"))
    ranked = counted.select(
        "class", "step", F.sum("n").over(down).alias("k"),
        F.sum("n").over(W.partitionBy("class")).alias("m"),
    )
    enough = F.exp(-F.col("step") / STEPS) <= false_share * F.col("k") / F.col("m")
    found = ranked.where(enough & (F.col("step") > 0)).groupBy("class").agg(F.min("step"))
    least = dict(map(tuple, found.collect()))  # a row for each class at most
    return [least.get(i, MOST_STEPS + 1) for i in range(len(ENCODINGS) * len(LENGTHS))]


def scanned(rows, text, keep, false_share=FALSE_SHARE):
    """The columns ``keep`` of ``rows``, and ``base`` and ``spans``: arrays of (start, kind
    number, end) in order.

    They are written once to the shared folder, before the p-values are looked at.
    """
    rows = rows.select(*keep, F.coalesce(text, F.lit("")).alias("_text"))
    found = candidates(rows, F.col("_text")).drop("_text")
    found = written(found, "secrets")
    tokens = F.col("candidates")
    each = found.select(F.explode(tokens).alias("t")).select("t.class", "t.step", "t.token")
    least = F.array(*map(F.lit, least_steps(each, false_share)))
    random = F.transform(
        F.filter(tokens, lambda c: c["step"] >= F.get(least, c["class"])),
        lambda c: F.struct(
            c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")
        ),
    )
    return found.select(*keep, "base", F.array_sort(F.concat("base", random)).alias("spans"))


def _written_out(spans):
    """kind:start:end of the spans, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.concat_ws(
        ",",
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])
        ),
    )


def scan(docs):
    """(doc_id, n_assign, n_access, n_hex, base, spans) of every row."""
    found = scanned(docs.select("doc_id", "text"), F.col("text"), ["doc_id"])
    counts = [
        F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long").alias(f"n_{kind}")
        for i, kind in enumerate(KINDS[:3])
    ]
    return found.select("doc_id", *counts, "base", "spans")


def digests(found):
    """Rows of ``scan`` with a digest of the base spans, and all spans as text."""
    return found.select(
        "doc_id",
        *[f"n_{kind}" for kind in KINDS[:3]],
        F.sha2(_written_out(F.col("base")), 256).alias("base_sha256"),
        _written_out(F.col("spans")).alias("spans"),
    )


def redacted(rows, text, spans, mark="[secret]"):
    """``rows`` with a mark in place of each span of the column ``text``; spans that overlap
    get one."""
    ends = F.transform(spans, lambda s: s["end"])
    both = F.struct(F.col(spans).alias("spans"), before(ends, F.greatest, 0).alias("reached"))

    def firsts(x):
        begun = F.transform(
            x["spans"],
            lambda s, i: F.struct(s["start"].alias("start"), F.get(x["reached"], i).alias("before")),
        )
        return F.filter(begun, lambda s: s["start"] >= s["before"])

    rows = rows.withColumn("_firsts", let(both, firsts))
    both = F.struct(F.col("_firsts").alias("firsts"), F.array_max(ends).alias("end"))

    def ended(x):
        # what overlaps ends where the spans before the next first one end
        return F.transform(
            x["firsts"],
            lambda s, i: F.struct(
                s["start"].alias("start"),
                F.coalesce(F.get(x["firsts"], i + 1)["before"], x["end"]).alias("end"),
            ),
        )

    rows = rows.withColumn("_apart", let(both, ended))
    return substituted(rows, text, "_apart", lambda _: F.lit(mark)).drop("_firsts", "_apart")


def redact(docs):
    """``docs`` with its secrets replaced in ``text``; ``n_chars``, if there, follows."""
    found = scanned(docs.select(F.struct("*").alias("row")), F.col("row.text"), ["row"])
    found = redacted(found.withColumn("text", F.col("row.text")), "text", "spans")
    replaced = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        replaced["n_chars"] = F.when(F.size("spans") > 0, length).otherwise(F.col("row")["n_chars"])
    return found.select(
        *[replaced.get(c, F.col("row")[c]).alias(c) for c in docs.columns]
    )
