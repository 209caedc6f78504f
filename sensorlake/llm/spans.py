"""Places of regular expressions in texts, and texts cut at places, with column functions only.

A text may have any number of matches. What runs along an array (``before``) goes block by
block, then along the totals of the blocks, because every step of an aggregate copies what it
has gathered. A text is cut in parts, these in smaller ones, and these at the places, because
finding a place costs what lies before it. The analyzer of a frame takes a limited depth of
nested functions, so callers use these in columns of their own, one after the other. The
optimizer may put the expression of a column where the column is used: a lambda gets what it
looks up from ``let``, else it would be computed anew for every entry.
"""

from pyspark.sql import functions as F

#: Entries of a block, and places of the smallest part of a text.
BLOCK, PART = 256, 64


def let(value, body):
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _blocks(n, size):
    """Numbers of the blocks of n entries; n is not 0."""
    return F.sequence(F.lit(0), F.floor((n - 1) / size).cast("int"))


def before(values, join, first, levels=2):
    """For each entry of an int array ``join`` of all entries before it; ``first`` joins
    with anything without a change. ``join`` is associative."""
    first = F.lit(first)
    start = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))

    def step(done, v):
        return F.struct(
            join(done["at"], v).alias("at"), F.concat(done["out"], F.array(done["at"])).alias("out")
        )

    if levels == 1:
        return F.aggregate(values, start, step, lambda done: done["out"])

    def joined(blocks):
        ahead = before(F.transform(blocks, lambda b: b["at"]), join, first, levels - 1)
        return let(
            ahead,
            lambda a: F.flatten(
                F.transform(
                    blocks,
                    lambda b, i: F.transform(b["out"], lambda v: join(F.get(a, i), v)),
                )
            ),
        )

    def whole(values):
        cut = F.transform(
            _blocks(F.size(values), BLOCK),
            lambda i: F.aggregate(F.slice(values, i * BLOCK + 1, BLOCK), start, step),
        )
        return F.when(F.size(values) > 0, let(cut, joined)).otherwise(F.array().cast("array<int>"))

    return let(values, whole)


def pieces(text, places, levels=3):
    """The text between each of the places (ascending, two at least) and the next."""

    def between(places, i):
        at = F.get(places, i)
        return F.substring(text, at + 1, F.get(places, i + 1) - at)

    if levels == 1:
        return F.transform(F.sequence(F.lit(0), F.size(places) - 2), lambda i: between(places, i))
    size = PART ** (levels - 1)

    def part(some):
        first = F.get(some, F.lit(0))
        own = F.substring(text, first + 1, F.element_at(some, -1) - first)
        inside = F.struct(own.alias("text"), F.transform(some, lambda p: p - first).alias("places"))
        return let(inside, lambda x: pieces(x["text"], x["places"], levels - 1))

    parts = F.transform(
        _blocks(F.size(places) - 1, size), lambda i: F.slice(places, i * size + 1, size + 1)
    )
    return F.flatten(F.transform(parts, part))


def substituted(rows, text, spans, new):
    """``rows`` with ``new(span)`` in place of each span of the column ``text``; the column
    ``spans`` is in order, and its spans are apart."""
    name, text, spans = text, F.col(text), F.col(spans)
    ends = F.flatten(F.transform(spans, lambda s: F.array(s["start"], s["end"])))
    places = F.concat(F.array(F.lit(0)), ends, F.array(F.char_length(text)))
    some = F.size(spans) > 0
    both = F.struct(text.alias("text"), places.alias("places"))
    cut = rows.withColumn(
        "_pieces", F.when(some, let(both, lambda x: pieces(x["text"], x["places"])))
    )

    def mixed(x):
        def one(t, i):
            span = F.get(x["spans"], F.floor(i / 2).cast("int"))
            return F.when(i % 2 == 0, t).otherwise(let(span, new))

        return F.array_join(F.transform(x["pieces"], one), "")

    both = F.struct(spans.alias("spans"), F.col("_pieces").alias("pieces"))
    return cut.withColumn(name, F.when(some, let(both, mixed)).otherwise(text)).drop("_pieces")


def matches(text, pattern, group=0):
    """Array of (start, end, part) of the matches, leftmost first; part is the group.

    What lies between the matches comes from splitting at the same pattern, so lengths
    add up to places.
    """
    none = F.array().cast("array<struct<start:int,end:int,part:string>>")
    both = F.struct(
        F.transform(F.split(text, pattern, -1), F.char_length).alias("gaps"),
        F.transform(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.char_length
        ).alias("found"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("parts"),
    )

    def placed(m):
        lengths = F.transform(m["found"], lambda n, i: n + F.get(m["gaps"], i))
        begins = before(lengths, lambda a, b: a + b, 0)

        def span(at, i):
            start = at + F.get(m["gaps"], i)
            return F.struct(
                start.alias("start"), (start + F.get(m["found"], i)).alias("end"),
                F.get(m["parts"], i).alias("part"),
            )

        return F.transform(begins, span)

    return F.when(F.rlike(text, F.lit(pattern)), let(both, placed)).otherwise(none)
