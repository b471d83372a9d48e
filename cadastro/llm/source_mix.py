"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Each source has a target number of words. Among all document rates that meet the targets, entropy
balancing takes those nearest to "every document once": with at most ``max_copies`` copies of a
document, the base law of the copies is binomial with mean 1, and the rates that meet the word
constraints with the least relative entropy are its exponential tilts

    rate(x) = m e^(tilt x) / (m - 1 + e^(tilt x)),   x = document size / mean size of its source,

one ``tilt`` per source. The tilts minimise a convex dual whose gradient and curvature are sums over
documents. Sizes are first counted into a histogram (source, size), so a source with a third of all rows
is pre-aggregated before anything is shuffled. Every Newton iteration is one distributed aggregate of
that histogram for all sources at once; a bracket around each root makes the steps safe, and each
iteration's state is a small table in the shared scratch folder.

Rates become whole copies: a document gets floor(rate) copies, and one more if its fixed uniform number,
a hash of its id and size, is below frac(rate) + shift. The shift of a source is found from a two-level
histogram of (number - frac) (at most 4,096 rows a source and level), so that the words taken stop just
short of the target. What is left is made up by a few documents rounded the other way: each round adds one,
takes one out or swaps two, whatever comes nearest to the gap. They are chosen from one document per size and
side of a source, so what a window sorts is bounded by the longest document, not by the number of documents.
Nothing is random, so reruns agree.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import _col, discard, materialise

log = logging.getLogger(__name__)

WORD = r"[^\x20\x09-\x0D]+"
BINS = 4096


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), max_copies: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, size, n): one row per source.

    Sources in code point order, null last, get the weights in turn and share all words by them; a target
    stops at ``max_copies`` times its source's size and the excess is shared again by weight. The common
    share per unit of weight solves sum(min(max_copies * size, share * weight)) = total: sources are
    ordered by the share at which they stop, and running sums find where the rest fit.
    """
    per_source = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    # These windows see one row per source, whatever the number of documents.
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    ranked = per_source.withColumn("weight", weight).withColumn("most", max_copies * F.col("source_size").cast("double"))
    order = Window.orderBy((F.col("most") / F.col("weight")), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything)
    share = (total - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    stepped = ranked.withColumn("share", share).withColumn("stops", F.col("most") <= F.col("weight") * F.col("share"))
    # The share of the first source that does not stop holds for it and all after it.
    common = F.min(F.when(~F.col("stops"), F.struct(F.col("most") / F.col("weight"), F.col("share")))).over(everything)
    return stepped.withColumn("common", common["share"]).select(
        "source", "source_size",
        F.when(F.col("common").isNull(), F.col("most")).otherwise(F.least(F.col("most"), F.col("weight") * F.col("common"))).alias("target"))


def _rate(tilt: Column, x: Column, m: int) -> Column:
    """m e^(tilt x) / (m - 1 + e^(tilt x)), written so that it never overflows."""
    return m / (1 + (m - 1) * F.exp(F.least(F.greatest(-tilt * x, F.lit(-700.0)), F.lit(700.0))))


def fit_tilts(sizes: DataFrame, targets: DataFrame, *, max_copies: int = 3, tolerance: float = 1e-7, max_iterations: int = 40) -> DataFrame:
    """``targets`` plus ``scale`` (mean size), ``tilt`` and ``full`` (every document max_copies times), and how
    the search for the tilt ended (``low``, ``high``, ``miss``).

    Newton iterations on the dual, all sources in one aggregate each. The step is kept inside a bracket
    of the root; where it would leave it, the bracket is halved. Iterations end when every source meets
    its target to ``tolerance``, or after ``max_iterations`` with a warning (the rounding then makes up the rest).
    """
    m = max_copies
    mean = sizes.where(F.col("size") > 0).groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("scale"))
    start = targets.join(mean, targets["source"].eqNullSafe(mean["source"]), "left").select(
        targets["source"], "source_size", "target", F.coalesce("scale", F.lit(1.0)).alias("scale"),
        (F.col("target") >= m * F.col("source_size") * (1 - 1e-9)).alias("full"),
        F.lit(0.0).alias("tilt"), F.lit(-1e3).alias("low"), F.lit(1e3).alias("high"), F.lit(1.0).alias("miss"))
    state = materialise(start, "mix_state")
    counted = sizes.where(F.col("size") > 0)
    for _ in range(max_iterations):
        x = F.col("size") / F.col("scale")
        rate = _rate(F.col("tilt"), x, m)
        seen = counted.join(state.where(~F.col("full")).select(F.col("source").alias("s"), "scale", "tilt"),
                            F.col("source").eqNullSafe(F.col("s")))
        sums = seen.groupBy("s").agg(
            F.sum(F.col("n") * x * rate).alias("reached"), F.sum(F.col("n") * x * x * rate * (1 - rate / m)).alias("curvature"))
        want = F.col("target") / F.col("scale")
        gradient = F.coalesce(F.col("reached"), want) - want
        low = F.when(gradient < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gradient > 0, F.col("tilt")).otherwise(F.col("high"))
        step = F.least(F.greatest(gradient / F.greatest(F.col("curvature"), F.lit(1e-12)), F.lit(-2.0)), F.lit(2.0))
        moved = state.join(sums, F.col("source").eqNullSafe(F.col("s")), "left").select(
            "source", "source_size", "target", "scale", "full", F.col("tilt").alias("old"),
            F.coalesce(step, F.lit(0.0)).alias("step"), low.alias("low"), high.alias("high"),
            F.when(F.col("full") | (want <= 0), 0.0).otherwise(F.abs(gradient) / want).alias("miss"))
        inside = (F.col("old") - F.col("step") > F.col("low")) & (F.col("old") - F.col("step") < F.col("high"))
        tilt = F.when(F.col("miss") <= tolerance, F.col("old")).when(inside, F.col("old") - F.col("step")).otherwise(
            (F.col("low") + F.col("high")) / 2)
        # Sums of doubles depend on the order of their parts in the last digits; rounded, reruns agree.
        tilt = F.round(tilt, 12)
        before, state = state, materialise(
            moved.select("source", "source_size", "target", "scale", "full", tilt.alias("tilt"), "low", "high", "miss"), "mix_state")
        discard(before)
        worst = state.agg(F.max("miss")).first()[0] or 0.0
        if worst <= tolerance:
            break
    else:
        log.warning("after %d iterations the rates of a source still miss its target by a share of %.2g", max_iterations, worst)
    return state


def _prepared(docs: DataFrame, state: DataFrame, max_copies: int) -> DataFrame:
    """Rows with ``_rate``, ``_base`` copies and ``_slack`` (uniform number less the rest of the rate).

    ``state`` has one row per source. It is reread from a table, so Catalyst knows its size: it is
    broadcast below Spark's own threshold and joined by a shuffle (with skew splitting) above it.
    """
    rate = F.when(F.col("_size") == 0, F.lit(1.0)).when(F.col("_full"), F.lit(float(max_copies))).otherwise(_rate(F.col("_tilt"), F.col("_size") / F.col("_scale"), max_copies))
    number = F.shiftrightunsigned(F.xxhash64("_id", "_size"), 11) / F.lit(float(1 << 53))
    named = state.select(*[F.col(c).alias(f"_{c}" if c != "source" else "_s") for c in state.columns])
    joined = docs.join(named, F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
    base = F.least(F.floor("_rate"), F.lit(max_copies)).cast("int")
    return joined.withColumn("_rate", rate).withColumn("_base", base).withColumn(
        "_slack", F.when((F.col("_base") >= max_copies) | (F.col("_size") == 0), F.lit(2.0)).otherwise(
            number - (F.col("_rate") - F.col("_base"))))


def _bin(slack: Column) -> Column:
    return F.floor((slack + 1) * (BINS // 2)).cast("int")


def _fine_bin(slack: Column) -> Column:
    scaled = (slack + 1) * (BINS // 2)
    return F.least(F.floor((scaled - F.floor(scaled)) * BINS), F.lit(BINS - 1)).cast("int")


def _cut(bins: DataFrame, level: str, rest: str) -> DataFrame:
    """Per source the first bin at which the running sum passes ``rest``, and the sum before it."""
    running = Window.partitionBy("_source").orderBy(level).rowsBetween(Window.unboundedPreceding, -1)
    summed = bins.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
    over = F.col("before") + F.col("words") > F.col(rest)
    return summed.where(over).groupBy("_source").agg(F.min(F.struct(level, "before")).alias("at")).select(
        F.col("_source").alias("s"), F.col(f"at.{level}").alias(f"_{level}"), (F.col("at.before")).alias(f"_{level}_before"))


def _nearest_change(menu: DataFrame, plan: DataFrame) -> DataFrame:
    """(m, miss, words, picks): per source the change that comes nearest to its gap.

    A change adds one document, takes one out, or swaps two. Additions stand at their size, withdrawals at
    their size plus the gap; in that order the best partner of a withdrawal is the addition next to it, on
    either side, so no pairs are formed. ``menu`` has one row per source, side and size.
    """
    open_ = plan.where(F.col("_open")).select("e", "_gap", "flips")
    left = menu.join(open_, F.col("_source").eqNullSafe(F.col("e"))).where(~F.array_contains("flips", F.col("pick"))).select(
        F.col("e").alias("m"), "_gap", "out", F.col("_size").alias("size"), F.array("pick").alias("picks"))
    nothing = open_.select(F.col("e").alias("m"), "_gap", F.explode(F.array(F.lit(False), F.lit(True))).alias("out"),
                           F.lit(0).cast("long").alias("size"), F.array().cast("array<long>").alias("picks"))
    events = left.unionByName(nothing).withColumn("place", F.col("size") + F.when(F.col("out"), F.col("_gap")).otherwise(0.0))
    order = Window.partitionBy("m").orderBy("place", "out", "size", F.size("picks"))
    addition = F.when(~F.col("out"), F.struct("size", "picks"))
    beside = events.withColumns({
        "lower": F.last(addition, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "upper": F.first(addition, ignorenulls=True).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))}).where("out")
    pairs = beside.select("m", "_gap", F.col("size").alias("less"), F.col("picks").alias("leaving"),
                          F.explode(F.array("lower", "upper")).alias("more")).where(F.col("more").isNotNull())
    words = F.col("more.size") - F.col("less")
    best = F.struct(F.abs(F.col("_gap") - words).alias("miss"), words.alias("words"), F.concat("more.picks", "leaving").alias("picks"))
    return pairs.groupBy("m").agg(F.min(best).alias("best")).select("m", "best.*")


def fit_rounding(rows: DataFrame, state: DataFrame, *, max_copies: int = 3, rounds: int = 6, close: float = 1e-6) -> DataFrame:
    """``state`` plus what the rounding needs: the bins where each source's extra copies end and the hashes
    of the documents rounded the other way (``flips``). ``rows`` has _id, _source, _size.

    Each round makes one change in every source that is off its target by more than a share of ``close``
    and that a change brings nearer; rounds end when none is left.
    """
    state = state.select("source", "source_size", "target", "scale", "tilt", "full")
    prepared = materialise(_prepared(rows, state, max_copies).select("_id", "_source", "_size", "_base", "_slack", "_target"), "mix_rates")
    taken = prepared.groupBy("_source").agg(
        F.sum(F.col("_base") * F.col("_size")).alias("whole"), F.max("_target").alias("goal"))
    extra = taken.select(F.col("_source").alias("e"), "goal", (F.col("goal") - F.col("whole")).alias("extra"))
    candidates = prepared.where(F.col("_slack") < 1).withColumn("coarse", _bin(F.col("_slack"))).withColumn("fine", _fine_bin(F.col("_slack")))
    coarse = candidates.groupBy("_source", "coarse").agg(F.sum("_size").alias("words")).join(extra, F.col("_source").eqNullSafe(F.col("e")))
    first = materialise(_cut(coarse, "coarse", "extra"), "mix_coarse")
    at = candidates.join(first, F.col("_source").eqNullSafe(F.col("s")) & (F.col("coarse") == F.col("_coarse")))
    fine = at.groupBy("_source", "fine", "_coarse_before").agg(F.sum("_size").alias("words")).join(
        extra, F.col("_source").eqNullSafe(F.col("e"))).withColumn("left", F.col("extra") - F.col("_coarse_before"))
    second = _cut(fine, "fine", "left").withColumnRenamed("s", "s2")
    # A source whose candidates all fit has no cut: every one of them gets its copy.
    cuts = materialise(extra.join(first, F.col("e").eqNullSafe(F.col("s")), "left").join(second, F.col("e").eqNullSafe(F.col("s2")), "left").select(
        "e", "goal", "extra", F.coalesce("_coarse", F.lit(BINS)).alias("_coarse"), F.coalesce("_fine", F.lit(BINS)).alias("_fine")), "mix_cuts")
    # The words within the cut, added up anew: without a cut they are all of the source's candidates.
    marked = candidates.join(cuts, F.col("_source").eqNullSafe(F.col("e"))).select(
        "_source", "_size", _below(F.col("coarse"), F.col("fine")).alias("out"), F.xxhash64("_id", "_size").alias("pick"))
    menu = materialise(marked.groupBy("_source", "out", "_size").agg(F.min("pick").alias("pick"), F.count("*").alias("n")), "mix_menu")
    within = menu.where("out").groupBy(F.col("_source").alias("w")).agg(F.sum(F.col("_size") * F.col("n")).alias("within"))
    gap = F.col("extra") - F.coalesce("within", F.lit(0))
    plan = materialise(cuts.join(within, F.col("e").eqNullSafe(F.col("w")), "left").select(
        "e", "goal", "_coarse", "_fine", gap.alias("_gap"), F.array().cast("array<long>").alias("flips"),
        (F.abs(gap) > close * F.col("goal")).alias("_open")), "mix_flips")
    for _ in range(rounds):
        if plan.where("_open").isEmpty():
            break
        better = F.coalesce(F.col("miss") < F.abs("_gap"), F.lit(False))
        gap = F.when(better, F.col("_gap") - F.col("words")).otherwise(F.col("_gap"))
        before, plan = plan, materialise(plan.join(_nearest_change(menu, plan), F.col("e").eqNullSafe(F.col("m")), "left").select(
            "e", "goal", "_coarse", "_fine", gap.alias("_gap"),
            F.when(better, F.concat("flips", "picks")).otherwise(F.col("flips")).alias("flips"),
            (better & (F.abs(gap) > close * F.col("goal"))).alias("_open")), "mix_flips")
        discard(before)
    off = plan.where(F.abs("_gap") > 0.01 * F.col("goal")).count()
    if off:
        log.warning("%d sources miss their target by more than 1%%: no few documents of theirs make it up", off)
    done = state.join(plan, F.col("source").eqNullSafe(F.col("e")), "left")
    rounded = materialise(done.select(*state.columns, F.col("_coarse").alias("coarse"), F.col("_fine").alias("fine"), "flips"), "mix_plan")
    discard(prepared, first, cuts, menu, plan)
    return rounded


def _below(coarse: Column, fine: Column) -> Column:
    """Whether a document's bins lie before its source's cut."""
    return (coarse < F.col("_coarse")) | ((coarse == F.col("_coarse")) & (fine < F.col("_fine")))


def _with_copies(rows: DataFrame, plan: DataFrame, max_copies: int) -> DataFrame:
    prepared = _prepared(rows, plan, max_copies)
    coarse, fine = _bin(F.col("_slack")), _fine_bin(F.col("_slack"))
    flipped = F.coalesce(F.array_contains("_flips", F.xxhash64("_id", "_size")), F.lit(False))
    more = (F.col("_slack") < 1) & (_below(coarse, fine) != flipped)
    return prepared.withColumn("_copies", F.col("_base") + F.coalesce(more, F.lit(False)).cast("int"))


def plan_mix(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[float] = (5.0, 2.0, 1.0), max_copies: int = 3,
) -> tuple[DataFrame, DataFrame]:
    """(rows, plan): narrow rows (_id, _source, _size), written once, and one plan row per source."""
    rows = materialise(docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), word_count(F.col(text_col)).alias("_size")), "mix_rows")
    sizes = materialise(rows.groupBy(F.col("_source").alias("source"), F.col("_size").alias("size")).agg(F.count("*").alias("n")), "mix_sizes")
    targets = materialise(source_targets(sizes, weights, max_copies), "mix_targets")
    state = fit_tilts(sizes, targets, max_copies=max_copies)
    plan = fit_rounding(rows, state, max_copies=max_copies)
    discard(sizes, targets, state)
    return rows, plan


def mix_table(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              weights: Sequence[float] = (5.0, 2.0, 1.0), max_copies: int = 3) -> DataFrame:
    """One row per document: id, source, size, source_size, target, rate, copies, taken (copies * size).

    Null text has size 0; a null source is a source of its own, last in order. Documents without words
    keep rate 1. Repeated rows (same id, size and source) share one uniform number and are rounded alike, so a
    small source made of them may end off its target; ties in size or order are decided by a hash of the id. A source without words has target 0. An empty table
    gives an empty one. Extra columns are not read.
    """
    rows, plan = plan_mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, weights=weights, max_copies=max_copies)
    return _with_copies(rows, plan, max_copies).select(
        F.col("_id").alias(id_col), F.col("_source").alias(source_col), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"), F.col("_rate").alias("rate"), F.col("_copies").alias("copies"),
        (F.col("_copies") * F.col("_size")).cast("long").alias("taken"))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = (5.0, 2.0, 1.0), max_copies: int = 3) -> DataFrame:
    """The mixed corpus: rows of ``docs`` (same columns, whatever their names), each as often as the mix takes
    it (0 to max_copies)."""
    names = docs.columns
    narrow, plan = plan_mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, weights=weights, max_copies=max_copies)
    discard(narrow)
    # The columns go by their places, so that none meets a column of the plan.
    rows = docs.select(*[_col(c).alias(f"column{i}") for i, c in enumerate(names)], F.col(id_col).alias("_id"),
                       F.col(source_col).alias("_source"), word_count(F.col(text_col)).alias("_size"))
    copies = _with_copies(rows, plan, max_copies).where(F.col("_copies") > 0)
    return copies.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(
        *[F.col(f"column{i}").alias(c) for i, c in enumerate(names)])
