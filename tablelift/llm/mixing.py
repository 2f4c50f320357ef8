"""Mixing sources to target weights: entropy balancing by Newton steps, then rates rounded into whole copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelift.llm import common

WORDS = r"[^\x20\x09-\x0D]+"
BINS = 4096


def words(text: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORDS)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """``sizes(source, source_size)`` with the target of each source.

    Sources in code-point order, null last, weigh ``weights``, repeating. ``share`` times all words is dealt by weight; a target stops
    at ``most`` times its source's size and the excess goes to the others by weight, until none is above: the level at which the
    capped shares add up, found over the sources ordered by the level at which each is full. One row per source goes through
    these windows, whatever the number of documents.
    """
    at = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (at % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most))
    rows = rows.withColumn("full", F.col("cap") / F.col("weight"))
    order = Window.orderBy("full", F.col("source").asc_nulls_last())
    below = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    above = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy(F.lit(0))) * float(share)
    rows = rows.withColumn("level", (total - below) / above)
    level = F.max(F.when(F.col("level") <= F.col("full"), F.col("level"))).over(Window.partitionBy(F.lit(0)))
    return rows.withColumn("target", F.least("cap", F.coalesce(level, F.lit(float("inf"))) * F.col("weight"))).select("source", "source_size", "target")


def balance(cells: DataFrame, wanted: DataFrame, most: float, tolerance: float = 1e-9, rounds: int = 40) -> DataFrame:
    """``wanted`` with ``tilt``: the dual variable of each source.

    ``cells(source, prior, size)`` holds the words of a source at each prior rate. Among all rates, those nearest to the priors in
    entropy per word that meet the targets are ``prior * exp(tilt)``, at most ``most``. Each Newton round is one aggregate over the
    cells and one division per source; only the largest relative error comes to the driver. Targets that no rates meet, or not in
    ``rounds`` rounds, are an error.
    """
    state = wanted.withColumn("tilt", F.lit(0.0))
    for turn in range(rounds):
        raw = F.col("prior") * F.exp("tilt")
        rate = F.least(raw, F.lit(float(most)))
        sums = (
            cells.withColumnRenamed("source", "own")
            .join(state, F.col("own").eqNullSafe(F.col("source")))
            .groupBy(F.col("source").alias("own"))
            .agg(F.sum(F.col("size") * rate).alias("mass"), F.sum(F.when(raw < most, F.col("size") * rate).otherwise(0.0)).alias("slope"))
        )
        state = state.join(sums, F.col("own").eqNullSafe(F.col("source"))).drop("own")
        gap = F.col("target") - F.col("mass")
        # Newton's step for exp(tilt): the mass is concave in it, so that a step from below never goes too far
        newton = F.log(F.greatest(1 + gap / F.col("slope"), F.lit(0.1)))
        nothing = F.when((F.col("mass") > 0) & (F.col("tilt") == 0), -50.0).otherwise(0.0)
        step = F.when(F.col("target") <= 0, nothing).when(F.col("slope") > 0, newton).when(gap < 0, -0.5).otherwise(0.0)
        done = F.abs(gap) <= tolerance * F.col("target")
        state = state.withColumn("error", F.when(done | (F.col("target") <= 0), 0.0).otherwise(F.abs(gap) / F.when(F.col("target") > 0, F.col("target"))))
        state = common.written(state.withColumn("tilt", F.col("tilt") + F.when(done, 0.0).otherwise(step)).drop("mass", "slope"), "newton")
        if not state.filter("error > 0").limit(1).count():
            break
        if turn + 1 < rounds:
            state = state.drop("error")
    else:
        worst = state.agg(F.max("error")).first()[0]
        raise RuntimeError(f"the rates do not meet the targets after {rounds} rounds: relative error {worst}")
    return state.select("source", "source_size", "target", "tilt")


def _expected(prior: Column, most: float, tilt: Column) -> Column:
    """Rate of a document; a hair below a whole number counts as that number."""
    rate = F.least(prior * F.exp(tilt), F.lit(float(most)))
    return F.when(F.abs(rate - F.round(rate)) < 1e-6, F.round(rate)).otherwise(rate)


def _place(rate: Column, draw: Column) -> Column:
    """Where a document comes in the order in which its source hands out one more copy, as an integer below BINS * BINS; documents of
    a larger fractional rate come earlier. Null if the rate is whole."""
    fraction = rate - F.floor(rate)
    key = draw / F.when(fraction > 0, fraction)
    return F.floor(key / (key + 1) * F.lit(float(BINS * BINS))).cast("long")


def plan(rows: DataFrame, weights=(3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per source: source_size, target, tilt, and ``last``, the place up to which its documents get one more copy.

    ``rows(source, size, prior, draw)``. Whole parts of the rates are copies for certain. Of the words still missing, histograms of
    the documents' places, coarse and then fine, give the place at which the copies come nearest to the target.
    """
    cells = common.written(rows.groupBy("source", "prior").agg(F.sum("size").alias("size")), "cells")
    sizes = cells.groupBy("source").agg(F.sum("size").alias("source_size"))
    tilted = balance(cells, common.written(targets(sizes, weights, share, most), "targets"), most)
    rate = _expected(F.col("prior"), most, F.col("tilt"))
    placed = rows.withColumnRenamed("source", "own").join(tilted, F.col("own").eqNullSafe(F.col("source"))).drop("own")
    placed = placed.select("source", "size", F.floor(rate).alias("sure"), _place(rate, F.col("draw")).alias("place"), "target")
    coarse = F.floor(F.col("place") / BINS)
    sure = F.sum(F.col("size") * F.col("sure")).alias("sure")
    bins = common.written(placed.groupBy("source", coarse.alias("bin")).agg(F.sum("size").alias("size"), sure, F.max("target").alias("target")), "bins")
    whole = Window.partitionBy("source")
    bins = bins.withColumn("missing", F.col("target") - F.sum("sure").over(whole)).filter("bin is not null")
    running = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    bins = bins.withColumn("before", F.sum("size").over(running) - F.col("size")).filter("before < missing")
    edge = bins.groupBy("source").agg(F.max(F.struct("bin", "before", "missing")).alias("edge")).select(F.col("source").alias("own"), "edge.*")
    edge = common.written(edge, "edge")
    fine = placed.join(edge, F.col("own").eqNullSafe(F.col("source")) & (coarse == F.col("bin")))
    fine = fine.groupBy("source", "place", "before", "missing").agg(F.sum("size").alias("size"))
    inside = Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    fine = fine.withColumn("after", F.col("before") + F.sum("size").over(inside))
    # a place is taken if that brings the total nearer to the target
    taken = fine.filter(F.col("after") - F.col("size") / 2 <= F.col("missing")).groupBy("source").agg(F.max("place").alias("last"))
    low = edge.select(F.col("own").alias("source"), (F.col("bin") * BINS - 1).alias("floor"))
    last = low.withColumnRenamed("source", "own").join(taken, F.col("own").eqNullSafe(F.col("source")), "left")
    last = last.select(F.col("own").alias("at"), F.coalesce("last", "floor").alias("last"))
    return common.written(tilted.join(last, F.col("at").eqNullSafe(F.col("source")), "left").drop("at").withColumn("last", F.coalesce("last", F.lit(-1))), "plan")


def mix(docs: DataFrame, weights=(3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0, text: str = "text", prior: Column | None = None) -> DataFrame:
    """``docs`` with size, source_size, target, rate and copies (0, 1, 2, ... whole copies of the document in the mix).

    ``prior`` is the rate that a document has before balancing, 1 by default, at most ``most``. The order in which documents of a
    source get one more copy is drawn from a hash of id, source and text, so that reruns agree; repeated rows share one place and are
    taken together. Null texts have size 0; null sources are one source, the last. An empty table gives no row. Columns of the
    added names are replaced, in whatever case, all others pass.
    """
    added = ("size", "source_size", "target", "rate", "copies")
    prior = F.lit(1.0) if prior is None else prior.cast("double")
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in added]
    # the plan's own columns get names that no document column has, in any case
    name = {n: common.free(docs, f"mix_{n}") for n in ("prior", "draw", "source", "tilt", "last")}
    draw = F.pmod(F.xxhash64("doc_id", "source", text), F.lit(1 << 40)) / F.lit(float(1 << 40))
    whole = docs.select(*kept, words(text).alias("size"), prior.alias(name["prior"]), draw.alias(name["draw"]))
    rows = common.written(whole.select("source", "size", F.col(name["prior"]).alias("prior"), F.col(name["draw"]).alias("draw")), "sizes")
    chosen = plan(rows, weights, share, most)
    chosen = chosen.select(F.col("source").alias(name["source"]), "source_size", "target", F.col("tilt").alias(name["tilt"]), F.col("last").alias(name["last"]))
    out = whole.join(chosen, F.col("source").eqNullSafe(F.col(name["source"])))
    rate = _expected(F.col(name["prior"]), most, F.col(name["tilt"]))
    more = F.coalesce(_place(rate, F.col(name["draw"])) <= F.col(name["last"]), F.lit(False)).cast("long")
    return out.select(*kept, "size", "source_size", "target", rate.alias("rate"), (F.floor(rate) + more).alias("copies"))


def op6_source_mixing(spark, sf_dir: str) -> DataFrame:
    """All documents mixed to one and a half times their words."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "rate")
