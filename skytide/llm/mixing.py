"""Mixing sources to target weights by entropy balancing.

Documents get rates, how often the mix takes them, as close to their base rate
as the token targets allow (least relative entropy): the rate is the base times
the exponential of a multiplier per source, limited to ``cap``. The multipliers
solve the convex dual; each Newton step is one aggregation over the words of each
source and base rate, on which alone rates depend, summed up beforehand. The Hessian
is diagonal because sources are disjoint. Only one row per source reaches the
driver. Sums are of integers, so reruns agree. Targets that are not met after
``STEPS`` steps are an error.

Rates become copies: the whole part for all, one more for the documents of a
source with the smallest ``u - fraction``, ``u`` a hash of id and text. The cut
is found by a histogram per source and a running sum within the one bin that
holds it, so the words taken miss the target by about one document.

A null text has no words; a null source is a source, the last one. A source
without words has target 0. Rows equal in id, text and source would share their
hash: the second and later ones get one of their own, by their number. Texts of any
length are counted whole. No rows give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skytide.operators.numbering import number_rows
from skytide.session import broadcast_if_small, small_table, stage

WEIGHTS = (5, 2, 1)
CAP = 3
BINS = 2048
STEPS = 40
WORD = r"[^\x20\x09-\x0D]+"
_FIXED = 1 << 40  # rates as integers, for sums that do not depend on their order


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: dict, weights=WEIGHTS, cap: float = CAP) -> dict:
    """Target words of each source: its weight's share of all words, at most ``cap``
    times its size, the excess shared again by weight among the others."""
    ordered = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(ordered)}
    full: set = set()
    while True:
        rest = sum(sizes.values()) - sum(cap * sizes[s] for s in full)
        open_ = [s for s in ordered if s not in full]
        total = sum(weight[s] for s in open_)
        share = {s: rest * weight[s] / total for s in open_}
        above = {s for s in open_ if share[s] > cap * sizes[s]}
        if not above:
            return {s: float(cap * sizes[s]) if s in full else float(share[s]) for s in ordered}
        full |= above


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, source, size, base, u``: what the balance needs of each document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"),
        F.lit(1.0).alias("base"),
        hash_of(F.col(id_col), text).alias("u"),
    )


def hash_of(doc_id, text):
    """A number in [0, 1) from id and text."""
    return F.shiftrightunsigned(F.xxhash64(doc_id, text), 11) / F.lit(float(1 << 53))


def apart(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``doc_id, source, u``) with different ``u`` for rows that are equal otherwise."""
    same = ["doc_id", "source", "u"]
    repeated = stage(rows.groupBy(*same).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"), "repeated-rows")
    if repeated.isEmpty():
        return rows
    known = broadcast_if_small(repeated)
    equal = F.lit(True)
    for c in same:
        equal = equal & rows[c].eqNullSafe(known[c])
    several = rows.join(known, equal, "left_semi").withColumn("_at", F.monotonically_increasing_id())
    numbered = number_rows(several, same, ["_at"], "_n", "numbered-rows")
    own = F.when(F.col("_n") == 0, F.col("u")).otherwise(hash_of(F.col("u"), F.col("_n")))
    return rows.join(known, equal, "left_anti").unionByName(numbered.withColumn("u", own).select(*rows.columns))


def _rate(cap: float):
    return F.least(F.lit(float(cap)), F.col("base") * F.exp("multiplier"))


def _with(rows: DataFrame, per_source: dict[str, dict]) -> DataFrame:
    """Join columns that hold one number per source."""
    sources = list(next(iter(per_source.values())))
    table = [{"own_source": s, **{c: float(v[s]) for c, v in per_source.items()}} for s in sources]
    schema = "own_source string, " + ", ".join(f"{c} double" for c in per_source)
    own = small_table(rows.sparkSession, table, schema)
    return rows.join(own, rows["source"].eqNullSafe(own["own_source"]), "left").drop("own_source")


def solve(rows: DataFrame, goal: dict, cap: float = CAP, steps: int = STEPS, tolerance: float = 1e-6) -> dict:
    """The multipliers: Newton's method on the dual, kept within what is known of each."""
    multiplier = dict.fromkeys(goal, 0.0)
    rows = stage(rows.groupBy("source", "base").agg(F.sum("size").alias("size")), "rated-words")
    open_ = {s for s in goal if goal[s] > 0}
    for s in goal.keys() - open_:
        multiplier[s] = -60.0
    low, high = dict.fromkeys(goal, -math.inf), dict.fromkeys(goal, math.inf)
    for _ in range(steps):
        rate = _rate(cap)
        fixed = F.round(rate * _FIXED).cast("decimal(20,0)") * F.col("size")
        sums = _with(rows, {"multiplier": multiplier}).groupBy("source").agg(
            F.sum(fixed.cast("decimal(38,0)")).alias("taken"),
            F.sum(F.when(rate < cap, fixed).otherwise(0).cast("decimal(38,0)")).alias("slope"),
            F.sum("size").alias("size"),
        )
        moved = False
        for row in sums.collect():
            if row.source not in open_:
                continue
            gradient, slope = float(row.taken) / _FIXED - goal[row.source], float(row.slope) / _FIXED
            if abs(gradient) <= max(tolerance * goal[row.source], float(row["size"]) / _FIXED):  # rates are no finer
                continue
            if slope == 0 and gradient < 0:  # every document is at the cap
                continue
            s, here = row.source, multiplier[row.source]
            low[s], high[s] = (here, high[s]) if gradient < 0 else (low[s], here)
            there = here + max(-2.0, min(2.0, -gradient / slope if slope else -1.0))
            # a step past a point known to be too far, as a kink at the cap can cause, is halved instead
            multiplier[s] = there if low[s] < there < high[s] else (low[s] + high[s]) / 2
            moved = True
        if not moved:
            return multiplier
    raise ArithmeticError(f"the targets are not met after {steps} Newton steps")


def plan(rows: DataFrame, weights=WEIGHTS, cap: float = CAP) -> dict[str, dict]:
    """Per source: ``source_size``, ``target``, ``multiplier`` and the cut of ``u - fraction``.

    ``rows`` (from ``measured``) is read several times: pass a staged table."""
    sizes = {r.source: int(r["n"]) for r in rows.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    if not sizes:
        return {}
    goal = targets(sizes, weights, cap)
    multiplier = solve(rows, goal, cap)
    rated = _with(rows, {"multiplier": multiplier}).withColumn("rate", _rate(cap)).where("size > 0")
    whole = F.floor("rate")
    key = F.col("u") - (F.col("rate") - whole)
    rated = rated.withColumn("whole", whole).withColumn("key", key).withColumn("bin", F.floor((F.col("key") + 1) * (BINS // 2)))
    extra = F.when(F.col("whole") < cap, F.col("size")).otherwise(0)
    need = dict.fromkeys(sizes, 0.0)
    bins: dict = {s: [] for s in sizes}
    # bins per source: a fixed number of rows
    for r in rated.groupBy("source", "bin").agg(F.sum(F.col("whole") * F.col("size")).alias("taken"), F.sum(extra).alias("extra")).collect():
        need[r.source] += r.taken
        bins[r.source].append((r.bin, r.extra))
    need = {s: goal[s] - need[s] for s in sizes}
    cut_bin, left = {}, {}
    for s in sizes:
        rest, cut = need[s], float(BINS + 1)
        for number, words in sorted(bins[s]):
            if words > rest:
                cut = float(number)
                break
            rest -= words
        cut_bin[s], left[s] = cut, rest
    edge = _with(rated.drop("multiplier"), {"cut_bin": cut_bin, "left": left}).where((F.col("bin") == F.col("cut_bin")) & (F.col("whole") < cap))
    order = W.partitionBy("source").orderBy("key").rangeBetween(W.unboundedPreceding, W.currentRow)
    fits = edge.withColumn("upto", F.sum("size").over(order)).where(F.col("upto") <= F.col("left"))
    # the last bin may end before its first document: then the cut is the bin's lower edge
    cut = {s: cut_bin[s] / (BINS // 2) - 1 - 1e-15 for s in sizes}
    for r in fits.groupBy("source").agg(F.max("key").alias("key")).collect():
        cut[r.source] = r.key
    return {"source_size": sizes, "target": goal, "multiplier": multiplier, "cut": cut}


def with_copies(rows: DataFrame, planned: dict[str, dict], cap: float = CAP) -> DataFrame:
    """Add ``copies`` to rows that have ``source, size, base, u``; one narrow join, no other shuffle."""
    rated = _with(rows, planned).withColumn("_rate", _rate(cap)).withColumn("_whole", F.floor("_rate"))
    more = (F.col("_whole") < cap) & (F.col("u") - (F.col("_rate") - F.col("_whole")) <= F.col("cut"))
    return rated.withColumn("copies", F.when(F.col("size") > 0, F.col("_whole") + more.cast("bigint")).otherwise(0)).drop("_rate", "_whole")


def mix(docs: DataFrame, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken``."""
    rows = stage(apart(stage(measured(docs), "measured")), "apart")
    planned = plan(rows, weights, cap)
    if not planned:
        planned = {c: {None: 0.0} for c in ("source_size", "target", "multiplier", "cut")}
    return with_copies(rows, planned, cap).select(
        "doc_id", "source", "size", F.col("source_size").cast("bigint").alias("source_size"), "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )
