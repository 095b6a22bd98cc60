"""Mixing sources to target weights along a time-varying curriculum.

A schedule gives a source's weight as a piecewise linear function of training progress from 0 to 1.
Its integral is the source's weight overall; targets share the corpus by these weights, no source
above ``cap`` times its size (the excess goes to the others by weight). Along the schedule the
integral up to t, scaled to the target, is the source's cumulative demand of words. A document
that starts after c words of its source's order is trained at the t where the demand reaches c, so
positions are the inverse of the demand: a square root within a segment.

A source's order is a hash of its documents. Whole passes over a source are followed by a last pass
that takes documents that still fit the rest of the target until none fits; one that does not fit
is skipped, however long it is. So the miss is below the smallest document not taken, or less if
a document that goes beyond the target comes nearer.

Running sums are distributed: the hash order is cut into pieces of about ``rows_per_piece``
documents, pieces are summed up, and only rows within a piece are numbered together. A source
that holds a third of all rows is spread over as many pieces as its size asks for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docmart.llm.common import materialize, pack_doc, word_count

Schedule = Sequence[tuple[float, float]]

# Weights 5, 2, 1 overall: the first kind fades out, the second stays, the third grows.
CURRICULUM: tuple[Schedule, ...] = (
    ((0.0, 7.5), (1.0, 2.5)),
    ((0.0, 2.0), (1.0, 2.0)),
    ((0.0, 0.5), (1.0, 1.5)),
)


def _segments(points: Schedule) -> Column:
    """Array of (start, w0, slope, before): before is the integral up to the segment."""
    if [points[0][0], points[-1][0]] != [0, 1] or any(w < 0 for _, w in points):
        raise ValueError("a schedule has weights of at least 0 from progress 0 to progress 1")
    out, before = [], 0.0
    for (t0, w0), (t1, w1) in zip(points, points[1:]):
        if t1 <= t0:
            raise ValueError("a schedule's points are in order")
        out.append(F.struct(*[F.lit(float(x)).alias(n) for x, n in (
            (t0, "start"), (w0, "w0"), ((w1 - w0) / (t1 - t0), "slope"), (before, "before"))]))
        before += (w0 + w1) / 2 * (t1 - t0)
    return F.array(*out)


def _area(points: Schedule) -> float:
    return sum((w0 + w1) / 2 * (t1 - t0) for (t0, w0), (t1, w1) in zip(points, points[1:]))


def _rows(docs: DataFrame, carry: bool) -> DataFrame:
    """The columns that order and weigh a document; ``u`` is its place in the source's order."""
    return docs.select(
        *([pack_doc(docs)] if carry else []),
        "doc_id", "source",
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null")).alias("skey"),
        word_count(F.col("text")).alias("size"),
        F.xxhash64("doc_id", F.xxhash64("text"), F.lit("order")).alias("u"))


def sources(rows: DataFrame, cycle: Sequence[Schedule], named: Mapping[str | None, Schedule],
            cap: float, rows_per_piece: int) -> DataFrame:
    """One row per source: sizes, target, whole passes, the rest of the target, schedule.

    Sources in code point order, NULL last, take the schedules of ``cycle`` in turn, unless
    ``named`` has one. A source is capped if ``cap`` times its size is below its share of what the
    sources with smaller size per weight leave; in the order of size per weight these are the
    first ones, so one running sum finds them all. One row per source is numbered in one task.
    """
    per = rows.groupBy("skey").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"),
                                   F.count(F.lit(1)).alias("n"))
    turn = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(cycle)
    area, shape = F.lit(None), F.lit(None)
    for i, points in enumerate(cycle):
        area = F.when(F.col("turn") == i, F.lit(_area(points))).otherwise(area)
        shape = F.when(F.col("turn") == i, _segments(points)).otherwise(shape)
    for name, points in named.items():
        own = F.col("source").eqNullSafe(F.lit(name))
        area, shape = F.when(own, F.lit(_area(points))).otherwise(area), F.when(own, _segments(points)).otherwise(shape)
    per = per.withColumn("turn", turn).withColumn("weight", area).withColumn("segments", shape)
    most = F.col("source_size") * F.lit(float(cap))
    order = W.orderBy(F.when(F.col("weight") > 0, most / F.col("weight")).asc_nulls_last(), "skey")
    total = F.sum("source_size").over(W.partitionBy())
    free = total - F.coalesce(F.sum(most).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    capped = (F.col("weight") > 0) & (F.col("free") * F.col("weight") >= most * F.col("rest"))
    per = per.withColumn("free", free).withColumn("rest", rest).withColumn("capped", capped)
    # The uncapped ones share what is free at the first of them.
    level = F.max(F.when(~F.col("capped") & (F.col("weight") > 0), F.col("free") / F.col("rest"))).over(W.partitionBy())
    target = F.when(F.col("capped"), most).otherwise(
        F.least(most, F.coalesce(level, F.lit(0.0)) * F.col("weight")))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(1))
    return (per.withColumn("target", target).withColumn("passes", passes.cast("long"))
            .select("skey", "source_size", "target", "passes", "weight", "segments",
                    (F.col("target") - F.col("passes") * F.col("source_size")).alias("part"),
                    (F.col("source_size") / F.col("n")).alias("mean"),
                    F.ceil(F.col("n") / F.lit(rows_per_piece)).alias("pieces")))


def _before() -> Column:
    """Words of the source's pieces before each piece."""
    window = W.partitionBy("skey").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum("size").over(window), F.lit(0).cast("long"))


def _takes() -> Column:
    """Whether the last pass takes a document: a round came by it with room for it, or it was picked.
    A blank one is taken up to the place where a pass without skips would end."""
    fits = F.exists("rounds", lambda x: (F.col("c") < x["upto"]) & (F.col("size") <= x["gap"]))
    return F.when(F.col("size") > 0, fits | F.array_contains("picks", F.col("c"))).otherwise(F.col("c") <= F.col("part"))


def _piece(u: Column, pieces: Column) -> Column:
    """Which of the source's pieces holds a place; grows with the place."""
    share = (u / F.lit(2.0 ** 64)) + F.lit(0.5)
    return F.least(F.floor(share * pieces), pieces - 1)


def _placed(rows: DataFrame, per: DataFrame, offsets: DataFrame) -> DataFrame:
    """``rows`` with ``c``, the words of the source before each document."""
    inside = W.partitionBy("skey", "piece").orderBy("u", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    return (rows.join(per.select("skey", "pieces"), "skey")
            .withColumn("piece", _piece(F.col("u"), F.col("pieces"))).drop("pieces")
            .join(offsets, ["skey", "piece"])
            .withColumn("c", F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))))


class Mix:
    """What a mix takes of each document, for narrow rows or for whole documents."""

    def __init__(self, docs: DataFrame, cycle: Sequence[Schedule] = CURRICULUM,
                 named: Mapping[str | None, Schedule] | None = None, cap: float = 3.0,
                 rows_per_piece: int = 1024):
        self.docs = docs
        rows = materialize(_rows(docs, carry=False), "mix_rows")
        per = materialize(sources(rows, cycle, named or {}, cap, rows_per_piece), "mix_sources")
        pieces = (rows.join(per.select("skey", "pieces"), "skey")
                  .groupBy("skey", _piece(F.col("u"), F.col("pieces")).alias("piece"))
                  .agg(F.sum("size").alias("size")))
        self.offsets = materialize(pieces.select(
            "skey", "piece", _before().alias("offset")), "mix_offsets")
        self.placed = materialize(_placed(rows, per, self.offsets)
                                  .select("doc_id", "skey", "piece", "u", "size", "c"), "mix_placed")
        self.per = self._last_pass(per)
        taken = (self.placed.join(self.per.select("skey", "part", "rounds", "picks"), "skey").filter(_takes())
                 .groupBy("skey", "piece").agg(F.sum("size").alias("size")))
        self.starts = materialize(taken.select(
            "skey", "piece", _before().alias("before")), "mix_starts")

    def _last_pass(self, per: DataFrame) -> DataFrame:
        """``per`` with what each source's last pass takes: rounds, picks and a document on top.

        The first round goes along the order and takes all that fits up to the first document that
        crosses the gap. From then on, if the largest document that fits is at least half the gap,
        it is picked; otherwise the documents that fit are taken along the order up to the next
        crossing, which leaves less than that largest one. So the gap halves with each round, and
        the rounds end when no document fits. ``best`` remembers the nearest miss from above.

        If only long documents are left then and the miss is above the mean document, the source
        starts once more with the smallest of them taken first: the shorter ones, more than
        enough now, fill the rest. The nearer of both ways counts.
        """
        state = per.select(
            "skey", "part", "mean", F.lit(False).alias("again"), F.lit(0).cast("long").alias("filled"),
            F.expr("cast(array() as array<struct<upto:bigint,gap:double>>)").alias("rounds"),
            F.expr("cast(array() as array<bigint>)").alias("picks"),
            F.expr("cast(null as struct<miss:double,filled:bigint,rounds:array<struct<upto:bigint,gap:double>>,picks:array<bigint>,c:bigint>)").alias("best"))
        gap, fit = F.col("part") - F.col("filled"), F.col("size") <= F.col("part") - F.col("filled")
        state, ended = materialize(state, "mix_state"), None
        while ended is None or not state.isEmpty():
            rest = self.placed.join(state, "skey").filter((F.col("size") > 0) & ~_takes())
            seen = rest.groupBy("skey").agg(
                F.max(F.when(fit, F.struct("size", (-F.col("c")).alias("c")))).alias("largest"),
                F.min(F.when(~fit, F.struct("size", "c"))).alias("over"), F.sum(F.when(fit, F.col("size"))).alias("all"))
            miss = F.col("over.size") - gap
            nearer = F.col("over").isNotNull() & (F.col("best").isNull() | (miss < F.col("best.miss")))
            step = (F.when(F.col("largest").isNull(), "end")
                    .when((F.size("rounds") > 0) & (2 * F.col("largest.size") >= gap), "pick")
                    .when(F.col("all") <= gap, "all").otherwise("cross"))
            after = materialize(
                state.join(seen, "skey", "left").withColumn("step", step).withColumn("best", F.when(nearer, F.struct(
                    miss.alias("miss"), "filled", "rounds", "picks", F.col("over.c").alias("c"))).otherwise(F.col("best")))
                .withColumn("step", F.when((F.col("step") == "end") & ~F.col("again") & (F.col("over.size") <= F.col("part"))
                                           & (F.least(gap, "best.miss") > F.col("mean")), "again").otherwise(F.col("step"))), "mix_seen")
            done = after.filter("step = 'end'").select("skey", "part", "filled", "rounds", "picks", "best")
            ended = done if ended is None else ended.union(done)
            # The piece in which the gap is crossed, then the document.
            here = (rest.filter(fit).select("skey", "piece", "size", "c", gap.alias("gap"))
                    .join(after.filter("step = 'cross'").select("skey"), "skey"))
            sums = here.groupBy("skey", "piece", "gap").agg(F.sum("size").alias("size")).withColumn("before", _before())
            piece = (sums.filter(F.col("before") + F.col("size") > F.col("gap"))
                     .groupBy("skey").agg(F.min(F.struct("piece", "before")).alias("x")).select("skey", "x.piece", "x.before"))
            inside = W.partitionBy("skey").orderBy("c").rowsBetween(W.unboundedPreceding, -1)
            at = (here.join(piece, ["skey", "piece"])
                  .withColumn("words", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
                  .filter(F.col("words") + F.col("size") > F.col("gap"))
                  .groupBy("skey").agg(F.min(F.struct("c", "words")).alias("at")))
            more = (F.when(F.col("step") == "pick", F.col("largest.size"))
                    .when(F.col("step") == "all", F.col("all")).otherwise(F.col("at.words")))
            upto = F.when(F.col("step") == "all", F.lit(2 ** 63 - 1)).otherwise(F.col("at.c"))
            onward = after.filter("step not in ('end', 'again')").join(at, "skey", "left").select(
                "skey", "part", "mean", "again", (F.col("filled") + more).alias("filled"),
                F.when(F.col("step") == "pick", F.col("rounds")).otherwise(F.concat("rounds", F.array(F.struct(
                    upto.alias("upto"), gap.alias("gap"))))).alias("rounds"),
                F.when(F.col("step") == "pick", F.concat("picks", F.array(-F.col("largest.c")))).otherwise(F.col("picks")).alias("picks"),
                "best")
            under = F.struct(gap.alias("miss"), "filled", "rounds", "picks", F.lit(None).cast("long").alias("c"))
            anew = after.filter("step = 'again'").select(
                "skey", "part", "mean", F.lit(True).alias("again"), F.col("over.size").alias("filled"),
                F.slice("rounds", 1, 0).alias("rounds"), F.array("over.c").alias("picks"),
                F.when(F.col("best.miss") < gap, F.col("best")).otherwise(under).alias("best"))
            state = materialize(onward.union(anew), "mix_state")
        above = F.coalesce(F.col("best.miss") < gap, F.lit(False))
        return materialize(per.drop("part").join(ended, "skey").select(
            *[c for c in per.columns],
            F.when(above, F.col("best.filled")).otherwise(F.col("filled")).alias("filled"),
            F.when(above, F.col("best.rounds")).otherwise(F.col("rounds")).alias("rounds"),
            F.when(above, F.col("best.picks")).otherwise(F.col("picks")).alias("picks"),
            F.when(above, F.col("best.c")).alias("extra")), "mix_targets")

    def _taken(self, placed: DataFrame) -> DataFrame:
        """``copies``: passes that take the document, and the progress ``t`` of each."""
        placed = (placed.join(self.per.drop("pieces"), "skey")
                  .join(self.starts, ["skey", "piece"], "left").withColumn("fits", _takes()))
        inside = W.partitionBy("skey", "piece").orderBy("u", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
        start = F.coalesce("before", F.lit(0)) + F.coalesce(
            F.sum(F.when(F.col("fits"), F.col("size"))).over(inside), F.lit(0))
        extra = (F.col("size") > 0) & F.coalesce(F.col("c") == F.col("extra"), F.lit(False))
        placed = placed.withColumn("start", F.when(extra, F.col("filled")).otherwise(start))
        copies = F.col("passes") + (F.col("fits") | extra).cast("long")

        def progress(k: Column) -> Column:
            # A document of the last pass starts where those taken before it end.
            words = k * F.col("source_size") + F.when(k == F.col("passes"), F.col("start")).otherwise(F.col("c"))
            area = F.when(F.col("target") > 0, words / F.col("target")).otherwise(F.lit(0.0)) * F.col("weight")
            s = F.element_at(F.filter("segments", lambda x: x["before"] <= area), -1)
            left = area - s["before"]
            root = s["w0"] + F.sqrt(F.greatest(s["w0"] * s["w0"] + 2 * s["slope"] * left, F.lit(0.0)))
            return s["start"] + F.when(left > 0, 2 * left / root).otherwise(F.lit(0.0))

        return (placed.withColumn("copies", copies)
                .withColumn("t", F.when(F.col("copies") > 0, F.transform(
                    F.sequence(F.lit(0).cast("long"), F.col("copies") - 1), progress))
                    .otherwise(F.expr("cast(array() as array<double>)"))))

    def documents(self) -> DataFrame:
        """doc_id, size, source_size, target, taken, copies, first_t: one row per document, in
        the order of training; documents that the mix leaves out come last.

        NULL and blank texts have size 0 and take nothing; a NULL source is a source of its own,
        the last one. Repeated rows are documents of their own. An empty table gives an empty result.
        """
        return (self._taken(self.placed)
                .select("doc_id", "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).alias("taken"), "copies",
                        F.try_element_at("t", F.lit(1)).alias("first_t"))
                .orderBy(F.col("first_t").asc_nulls_last(), "doc_id"))

    def corpus(self) -> DataFrame:
        """The documents as often as the mix takes them, with the input's columns, range-sorted
        by training position."""
        rows = _placed(_rows(self.docs, carry=True), self.per, self.offsets)
        return (self._taken(rows.select("doc", "doc_id", "skey", "piece", "u", "size", "c"))
                .select("doc", "doc_id", F.explode("t").alias("t"))
                .repartitionByRange("t", "doc_id").sortWithinPartitions("t", "doc_id").select("doc.*"))
