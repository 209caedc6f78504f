"""Quality by weak supervision: rules vote, and their accuracies are learned.

Every rule looks at counts of a document and votes good (1), bad (-1) or abstains (0).
No rule is trusted as such: expectation-maximisation over all documents estimates for
each rule how often it votes right, wrong or not at all on good and on bad documents, and
the share of good documents. A document is kept if its posterior probability of being
good is at least ``KEEP``, and the base rules do not fail.

The votes of all documents are counted by pattern, with partial sums before the shuffle;
there are at most 3 to the number of rules of them, whatever the number of documents.
The estimation runs over that table in one expression; only the estimates, a number per
rule, meet the documents again. All of it is DataFrame functions.

Null text has no words. A document without words fails the base rules. Repeated rows are
judged each by itself and count each in the estimates. An empty table gives no rows.
Other columns are left out of the counts, whatever their names.
"""

from pyspark.sql import functions as F

from sensorlake.llm.spans import let
from sensorlake.session import written

#: White space: blank and the control characters tab to carriage return.
SPACE = r"\x20\x09-\x0D"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words
WINDOW = 3
KEEP = 0.5
ROUNDS = 25
#: Where the estimation starts: shares of bad, no and good votes of any rule on good and
#: on bad documents, and the share of good documents.
START_ON_GOOD, START_ON_BAD, START_SHARE = (0.03, 0.17, 0.8), (0.45, 0.2, 0.35), 0.8
#: No share is nearer to certainty than this.
MARGIN = 0.002
#: Short words that running text of some languages is full of.
FUNCTION_WORDS = (
    "the of and to in is that with for on are as by or der die und das ist zu den mit von "
    "ein nicht sich auf le la les de et des un une du est pas dans que qui pour el los las "
    "en por del con se es su no y"
).split()

_LONG = "long"


def _high(bits):
    """All bits of a long but the lowest so many."""
    return F.call_function("shiftleft", F.lit(-1).cast(_LONG), bits)


def _repeated(words):
    """How many words lie in windows that occur at least twice.

    Hash and place of each window are packed into one number, so that sorting plain
    numbers brings equal windows together; neighbours with equal hash bits count as
    equal only if their words are. The windows found are then walked in order of place.
    """
    n = F.size(words) - (WINDOW - 1)

    def found(n_places):
        bits = F.ceil(F.log2((n_places + 1).cast("double"))).cast("int")
        return let(bits, lambda b: let(_keys(b), lambda keys: _covered(keys, b)))

    def _keys(bits):
        def key(word, i):
            window = F.xxhash64(word, F.get(words, i + 1), F.get(words, i + 2))
            return window.bitwiseAND(_high(bits)).bitwiseOR(i.cast(_LONG))

        return F.sort_array(F.transform(F.slice(words, F.lit(1), n), key))

    def _covered(keys, bits):
        def place(key):
            return key.bitwiseAND(F.bitwise_not(_high(bits)))

        def same(a, b):
            """Whether two keys are those of equal windows; false if there is no other."""
            at, to = place(a).cast("int"), place(b).cast("int")
            equal = a.bitwiseXOR(b).bitwiseAND(_high(bits)) == 0
            for j in range(WINDOW):
                equal = equal & (F.get(words, at + j) == F.get(words, to + j))
            return F.coalesce(equal, F.lit(False))

        twice = F.filter(
            keys, lambda k, i: same(k, F.get(keys, i + 1)) | same(k, F.get(keys, i - 1))
        )
        places = F.array_sort(F.transform(twice, place))
        step = F.struct(F.lit(0).cast(_LONG).alias("n"), F.lit(0).cast(_LONG).alias("end"))

        def cover(done, at):
            n_new = at + WINDOW - F.greatest(at, done["end"])
            return F.struct((done["n"] + n_new).alias("n"), (at + WINDOW).alias("end"))

        return F.aggregate(places, step, cover, lambda done: done["n"])

    return F.when(n >= 2, found(n)).otherwise(F.lit(0).cast(_LONG))


#: Words of marks only.
_BARE = rf"(?<![^{SPACE}])[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+(?![^{SPACE}])"


def counts(text):
    """Struct of the counts that the base and the rules look at."""
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(f"[^{SPACE}]+"), F.lit(0))

    def dup_lines(t):
        lines = F.filter(F.split(t, "\n"), lambda x: F.rlike(x, F.lit(f"[^{SPACE}]")))
        return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast(_LONG))

    def of(w):
        joined = F.array_join(w, "")
        return let(
            joined,
            lambda j: F.struct(
                F.size(w).cast(_LONG).alias("n_words"),
                F.char_length(j).cast(_LONG).alias("word_chars"),
                F.regexp_count(text, F.lit(SYMBOLS)).cast(_LONG).alias("n_symbols"),
                dup_lines(text).alias("n_dup_lines"),
                _repeated(w).alias("n_repeat_words"),
                F.regexp_count(text, F.lit("\n")).cast(_LONG).alias("n_breaks"),
                F.regexp_count(j, F.lit("[A-Z]")).cast(_LONG).alias("n_upper"),
                F.regexp_count(j, F.lit("[!?|]")).cast(_LONG).alias("n_marks"),
                F.regexp_count(text, F.lit(_BARE)).cast(_LONG).alias("n_bare"),
                F.size(F.array_intersect(w, F.array(*map(F.lit, FUNCTION_WORDS))))
                .cast(_LONG).alias("n_function"),
            ),
        )

    return let(words, of)


def rules(c):
    """Name and vote of each rule, by the counts ``c``."""

    def vote(good, bad):
        return F.when(bad, -1).when(good, 1).otherwise(0)

    n, chars, breaks = c["n_words"], c["word_chars"], c["n_breaks"]
    length = chars / F.greatest(n, F.lit(1))
    return {
        "length": vote(n >= 80, n < 20),
        "word_length": vote(length.between(3.5, 8.0), (length < 2.5) | (length > 12.0)),
        "symbols": vote(50 * c["n_symbols"] < n, 10 * c["n_symbols"] > n),
        "bare_words": vote(50 * c["n_bare"] < n, 10 * c["n_bare"] > n),
        "function_words": vote(c["n_function"] >= 3, (c["n_function"] == 0) & (n >= 30)),
        "lines": vote(10 * c["n_dup_lines"] <= breaks, 3 * c["n_dup_lines"] > breaks + 1),
        "repeats": vote(4 * c["n_repeat_words"] < n, 5 * c["n_repeat_words"] > 2 * n),
        "capitals": vote(10 * c["n_upper"] < chars, 2 * c["n_upper"] > chars),
        "marks": vote(10 * c["n_marks"] < n, 2 * c["n_marks"] > n),
    }


def base_failed(c):
    return (c["n_words"] < MIN_WORDS) | (
        100 * c["n_repeat_words"] > MAX_REPEATED * c["n_words"]
    )


def _bounded(x):
    return F.least(F.lit(1 - MARGIN), F.greatest(F.lit(MARGIN), x))


def estimates(voted, n_rules):
    """(share of good documents, shares of votes on good ones, on bad ones).

    The shares stand three to a rule: bad, none, good. Every round takes the posterior of
    each pattern of ``votes`` under the shares so far and counts the votes anew. Sums run
    over patterns in order, so equal input gives equal estimates.
    """
    patterns = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n"))
    gathered = patterns.agg(F.array_sort(F.collect_list(F.struct("votes", "n"))).alias("rows"))

    def array(values):
        return F.array(*[F.lit(x) for x in values])

    start = F.struct(
        F.lit(START_SHARE).alias("share"),
        array(START_ON_GOOD * n_rules).alias("on_good"),
        array(START_ON_BAD * n_rules).alias("on_bad"),
    )
    zeros = array([0.0] * 3 * n_rules)
    empty = F.struct(
        F.lit(0.0).alias("n"), F.lit(0.0).alias("p"), zeros.alias("good"), zeros.alias("bad")
    )

    def again(model, _):
        def add(sums, row):
            n, votes = row["n"].cast("double"), row["votes"]

            def counted(p):
                def grown(kind, share):
                    return F.array(
                        *[
                            sums[kind][3 * j + v + 1]
                            + F.when(votes[j] == v, n * share).otherwise(0.0)
                            for j in range(n_rules)
                            for v in (-1, 0, 1)
                        ]
                    ).alias(kind)

                return F.struct(
                    (sums["n"] + n).alias("n"),
                    (sums["p"] + n * p).alias("p"),
                    grown("good", p),
                    grown("bad", 1 - p),
                )

            p = posterior(model["share"], model["on_good"], model["on_bad"], votes, n_rules)
            return let(p, counted)

        def new(sums):
            def shares(kind, of):
                return F.transform(sums[kind], lambda x: _bounded(x / of)).alias(f"on_{kind}")

            share = _bounded(sums["p"] / sums["n"])
            return F.struct(
                share.alias("share"),
                shares("good", share * sums["n"]),
                shares("bad", (1 - share) * sums["n"]),
            )

        return let(F.aggregate("rows", empty, add), new)

    rounds = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, again)
    model = F.when(F.size("rows") > 0, rounds).otherwise(start)
    row = gathered.select(model.alias("model")).first()["model"]
    return row["share"], list(row["on_good"]), list(row["on_bad"])


def posterior(share, on_good, on_bad, votes, n_rules):
    """Probability that a document with these votes is good."""
    yes, no = share, 1 - share
    for j in range(n_rules):
        v, i = votes[j], 3 * j
        yes = yes * F.when(v == 1, on_good[i + 2]).when(v == 0, on_good[i + 1]).otherwise(on_good[i])
        no = no * F.when(v == 1, on_bad[i + 2]).when(v == 0, on_bad[i + 1]).otherwise(on_bad[i])
    return yes / (yes + no)


def judged(counted):
    """``counted``, with its column ``counts``, and the struct ``quality``: votes,
    base_failed, posterior, kept.

    The rows are written once to the shared folder and read for both passes.
    """
    counted = written(counted, "counts")
    votes = rules(F.col("counts"))
    voted = counted.withColumn("votes", F.array(*votes.values()))
    model = estimates(voted.select("votes"), len(votes))
    p = posterior(F.lit(model[0]), *model[1:], F.col("votes"), len(votes))
    failed = base_failed(F.col("counts"))
    quality = F.struct(
        "votes",
        failed.alias("base_failed"),
        p.alias("posterior"),
        (~failed & (p >= KEEP)).alias("kept"),
    )
    return voted.select(*counted.columns, quality.alias("quality"))


def verdicts(docs):
    """(doc_id, counts, base_failed, kept, posterior, votes) of every row."""
    found = judged(docs.select("doc_id", counts(F.col("text")).alias("counts")))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return found.select(
        "doc_id",
        *[f"counts.{c}" for c in names],
        "quality.base_failed",
        "quality.kept",
        "quality.posterior",
        "quality.votes",
    )


def drop_poor(docs):
    """``docs`` without the rows that are not kept."""
    counted = docs.select(F.struct("*").alias("row"), counts(F.col("text")).alias("counts"))
    return judged(counted).where("quality.kept").select("row.*")
