"""Mixing sources to target weights by iterative proportional fitting.

Token weights of the cells (source, language, topic) are raked to target marginals of the three
dimensions in turn until every marginal fits.  A document's probability is its cell's weight over the cell's
tokens, times a common scale.  The scale is such that ``keep`` of all tokens are drawn by expectation; a cell whose
probability would exceed 1 is kept whole, and the scale of the others makes up for it, so that a tiny cell does not lower the rate of
the rest.  Without ``keep`` the most wanted cell keeps all of its documents and no other limit holds, so all marginals fit exactly.
Documents are drawn by a hash of their id, so that a rerun draws the same ones.

Only DataFrame functions are used.  The cells are one row per combination that occurs, far fewer than
documents; rounds are windows over that table, and the table is written to the
shared checkpoint folder after some rounds.  A hot source is summed per task before the shuffle.  Weights that still move after the
last round are warned about.

The topic is the column ``topic`` where documents have one, else the text's form; tokens are ``n_tokens`` where given, else a quarter of
the code points.  Given columns ``probability`` and ``selected`` are replaced, others kept.
Null source, language or topic is a level of its own, null or empty text has no tokens, and a cell without
tokens keeps factor 1.  Repeated rows are drawn together; rows with null doc_id are drawn by their texts.  A very long
text is one document with its tokens.  An empty table gives no rows.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, whole_text

DIMS = ("source", "lang", "topic")
#: Rounds between two writes of the table.
STRIDE = 5


def text_form(text: Column) -> Column:
    """A coarse topic from the text's form, where no topic column is given."""
    n = F.greatest(F.length(text), F.lit(1))
    of = lambda chars: F.length(text) - F.length(F.translate(text, chars, ""))
    return (
        F.when(of("|") * 50 > n, "table")
        .when(of("0123456789") * 20 > n, "figures")
        .when(of("@/#%*{}[]<>=_") * 50 > n, "markup")
        .when(of("\n") * 100 > n, "lines")
        .otherwise("prose")
    )


def token_estimate(text: Column) -> Column:
    return F.ceil(F.length(text) / 4).cast("long")


def rake(cells: DataFrame, targets: dict[str, DataFrame] | None = None, temperature: float = 0.9, rounds: int = 40, tolerance: float = 1e-6) -> DataFrame:
    """cells (source, lang, topic, mass) -> the same with weight.

    targets: per dimension a DataFrame (level, share); a level that is not named gets no weight.
    Without it a dimension's target is its own share to the power of temperature, which lifts small levels.
    """
    scratch = Scratch(cells.sparkSession, "mixing")
    base = scratch.keep(cells.withColumn("weight", F.col("mass").cast("double")), "cells")
    cells = base
    for dim in DIMS:
        if targets and dim in targets:
            level = targets[dim].select(F.col("level").alias(dim), F.col("share").cast("double").alias("m"))
        else:
            level = cells.groupBy(dim).agg(F.sum("mass").cast("double").alias("m")).filter("m > 0").withColumn("m", F.pow("m", F.lit(temperature)))
        whole = level.agg(F.sum("m")).first()[0] or 1.0
        level = level.select(dim, (F.col("m") / whole).alias(f"want_{dim}"))
        base = base.alias("c").join(level.alias("l"), F.col(f"c.{dim}").eqNullSafe(F.col(f"l.{dim}")), "left").drop(F.col(f"l.{dim}"))
        base = base.withColumn(f"want_{dim}", F.coalesce(f"want_{dim}", F.lit(0.0)))
    whole = cells.agg(F.sum("weight")).first()[0] or 1.0
    state = scratch.keep(base.withColumn("weight", F.col("weight") / whole), "start")
    moved, done = None, 0
    while done < rounds:
        fitted = state
        for _ in range(min(STRIDE, rounds - done)):
            for dim in DIMS:
                has = F.sum("weight").over(Window.partitionBy(dim))
                fitted = fitted.withColumn("weight", F.when(has > 0, F.col("weight") * F.col(f"want_{dim}") / has).otherwise(0.0))
        fitted = scratch.keep(fitted, "rounds")
        done += STRIDE
        # The last dimension fits exactly; a marginal that can't be reached ends the loop by standing still.
        off = fitted.alias("a").join(state.select(*DIMS, F.col("weight").alias("before")).alias("b"), [F.col(f"a.{d}").eqNullSafe(F.col(f"b.{d}")) for d in DIMS])
        moved = off.agg(F.max(F.abs(F.col("weight") - F.col("before"))).alias("d")).first()["d"]
        scratch.drop(state)
        state = fitted
        if moved is None or moved < tolerance:
            break
    if moved is not None and moved >= tolerance:
        warnings.warn(f"raking stopped after {rounds} rounds, while weights still moved by {moved:.1e}", stacklevel=2)
    return state.select(*DIMS, "mass", "weight")


def calibrated(weights: DataFrame, keep: float | None) -> DataFrame:
    """Cells with mass and weight -> the same with cell_p, their documents' probability."""
    factor = Scratch(weights.sparkSession, "mixing").keep(weights.withColumn("factor", F.when(F.col("mass") > 0, F.col("weight") / F.col("mass"))), "factors")
    most, want = factor.agg(F.max("factor"), F.sum("mass") * float(keep or 0)).first()
    scale = 1.0 / most if most else 1.0
    if keep and most:
        scale, before = 0.0, -1.0
        while scale > before:  # it only grows, as long as further cells are kept whole
            free = F.col("factor") * scale < 1
            spent, left = factor.filter("mass > 0").agg(F.sum(F.when(~free, F.col("mass")).otherwise(0)), F.sum(F.when(free, F.col("mass") * F.col("factor")).otherwise(0.0))).first()
            before, scale = scale, (float(want) - spent) / left if left and want > spent else scale
            if scale <= before * (1 + 1e-12):
                break
    return factor.withColumn("cell_p", F.coalesce(F.least(F.lit(1.0), F.col("factor") * scale), F.lit(1.0)))


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, temperature: float = 0.9, seed: int = 17, topic: Column | None = None, tokens: Column | None = None, keep: float | None = None) -> DataFrame:
    """docs with source, lang and text -> docs plus topic, n_tokens, probability and selected."""
    text = whole_text("text")
    if topic is None:
        topic = F.col("topic") if "topic" in docs.columns else text_form(text)
    if tokens is None:
        tokens = F.col("n_tokens").cast("long") if "n_tokens" in docs.columns else token_estimate(text)
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.col("doc_id"))
    own = docs.select(F.struct("*").alias("row"), key.alias("key"), "source", "lang", topic.cast("string").alias("topic"), F.coalesce(tokens, F.lit(0)).alias("n_tokens"))
    cells = own.groupBy(*DIMS).agg(F.sum("n_tokens").alias("mass"))
    factor = calibrated(rake(cells, targets, temperature), keep)
    factor = factor.select(*[F.col(d).alias(f"cell_{d}") for d in DIMS], "cell_p")
    joined = own.join(factor, [F.col(d).eqNullSafe(F.col(f"cell_{d}")) for d in DIMS], "left")
    draw = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("key")), 11)).cast("double") / float(2**53)
    probability = F.coalesce("cell_p", F.lit(0.0))
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c not in ("topic", "n_tokens", "probability", "selected")]
    return joined.select(*kept, "topic", "n_tokens", probability.alias("probability"), (draw < probability).alias("selected"))
