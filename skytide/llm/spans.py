"""Where patterns match, as column expressions: no Python on the rows.

Spark's regular expressions return what matched but not where. The pieces
between matches and the matches themselves add up to the positions, in code
points, end exclusive. Patterns must not match the empty string.

A lambda works out anew whatever expression it mentions, for every element. So what
is wanted once a text is bound first, as the only element of an array (``once``),
and running positions are added up in pieces of ``PIECE`` matches: arrays grow only
within a piece. The work is all but linear in the text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PIECE = 256
SPAN = "array<struct<start: int, kind_no: int, end: int, kind: string, value: string>>"


def once(value: Column, use) -> Column:
    """``use(value)``, with ``value`` worked out a single time."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _pieces(items: Column) -> Column:
    """Numbers of the pieces of an array; none of an empty one."""
    count = F.ceil(F.size(items) / PIECE).cast("int")
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def _piece(items: Column, k: Column) -> Column:
    return F.slice(items, k * PIECE + 1, F.lit(PIECE))


def located(text: Column, pattern: str, kind: str, kind_no: int, value_group: int = 0) -> Column:
    """Leftmost non-overlapping matches as ``SPAN``; ``value`` is the given group."""
    parts = {"gap": F.split(text, pattern, -1)}
    if value_group:
        parts["value"] = F.regexp_extract_all(text, F.lit(pattern), value_group)

    def zipped(matches: Column) -> Column:
        """Matches with the gap before each; the last gap follows the last match, it belongs to none."""
        with_gaps = F.arrays_zip(matches.alias("match"), *[c.alias(n) for n, c in parts.items()])
        return F.filter(with_gaps, lambda m: m["match"].isNotNull())

    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))

    def spans(m: Column) -> Column:
        length = lambda x: F.length(x["gap"]) + F.length(x["match"])
        totals = F.transform(_pieces(m), lambda k: F.aggregate(_piece(m, k), F.lit(0), lambda n, x: n + length(x)))
        begun = F.aggregate(totals, nothing, lambda s, n: F.struct((s["at"] + n).alias("at"), F.concat(s["starts"], F.array(s["at"])).alias("starts")))
        return F.flatten(F.transform(begun["starts"], lambda at, k: of_piece(_piece(m, k), at)))

    def of_piece(m: Column, at: Column) -> Column:
        start = F.struct(at.alias("at"), F.array().cast(SPAN).alias("spans"))

        def step(state, x):
            first = state["at"] + F.length(x["gap"])
            last = first + F.length(x["match"])
            value = x["value" if value_group else "match"]
            span = F.struct(first.alias("start"), F.lit(kind_no).alias("kind_no"), last.alias("end"), F.lit(kind).alias("kind"), value.alias("value"))
            return F.struct(last.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

        return F.aggregate(m, start, step)["spans"]

    # where nothing matches, as in most texts, nothing else is looked for
    found = lambda m: F.when(F.size(m) > 0, once(zipped(m), spans)).otherwise(F.array().cast(SPAN))
    return once(F.regexp_extract_all(text, F.lit(pattern), 0), found)


def only_if(condition: Column, spans: Column) -> Column:
    """Skip the search in texts that cannot match."""
    return F.when(condition, spans).otherwise(F.array().cast(SPAN))


def in_order(*spans: Column) -> Column:
    """All spans by start, then kind."""
    return F.array_sort(F.concat(*spans))


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of each, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def outside(spans: Column, others: Column) -> Column:
    """The spans that overlap none of ``others``: piece by piece, most of which a span
    is clear of as a whole."""

    def bounded(items: Column) -> Column:
        low, high = F.array_min(F.transform(items, lambda o: o["start"])), F.array_max(F.transform(items, lambda o: o["end"]))
        return F.struct(low.alias("start"), high.alias("end"), items.alias("items"))

    meets = lambda s, o: (o["start"] < s["end"]) & (s["start"] < o["end"])
    pieces = once(others, lambda found: F.transform(_pieces(found), lambda k: bounded(_piece(found, k))))
    return once(pieces, lambda ps: F.filter(spans, lambda s: ~F.exists(ps, lambda p: meets(s, p) & F.exists(p["items"], lambda o: meets(s, o)))))


def replaced(text: Column, spans: Column, label) -> Column:
    """``text`` with each span replaced by ``label(span)``; of overlapping spans the later start is skipped."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state, s):
        upto = F.concat(state["out"], F.substring(text, state["at"] + 1, s["start"] - state["at"]), label(s))
        return F.when(s["start"] >= state["at"], F.struct(s["end"].alias("at"), upto.alias("out"))).otherwise(state)

    done = F.aggregate(spans, start, step)
    return F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))
