"""Mixing sources to target weights by iterative proportional fitting.

Token weights of the cells (source, language, topic) are raked in turn to the target share of
each source, each language and each topic; a document is then kept with its cell's calibrated
probability, decided by a hash of its id and text.

No cell can give more tokens than it has. Its weight is held to that bound in every step, and the
next sweeps move what it cannot give to the other cells of its source, language and topic. A target
beyond what all cells of its value have is lowered to that, and the others share the difference.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.workspace import stored

#: Target shares flatten the token shares: proportional to share ** FLATTEN.
FLATTEN = 0.7
#: Tokens kept, as a part of all.
BUDGET = 0.6
#: Sweeps between two looks at the misses; raking goes on while the largest is above the tolerance and shrinks.
SWEEPS, TOLERANCE, PROGRESS = 4, 1e-3, 0.98
NONE = "(none)"
DIMENSIONS = ("source", "lang", "topic")

log = logging.getLogger(__name__)


def tokens(text: Column) -> Column:
    """Words of a text: runs of characters other than white space."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t\n\f\r\x0B]+"), lambda w: w != "")).cast("long")


def topic(text: Column) -> Column:
    """A text's form as its topic: licence, table, shouted, marked up, long or short prose."""
    text = F.coalesce(text, F.lit(""))
    return (
        F.when(F.contains(F.lower(text), F.lit("license")), "licence").when(F.contains(text, F.lit(" | ")), "table")
        .when(F.contains(text, F.lit("!! ")), "shouted").when(F.contains(text, F.lit("$$$")), "markup")
        .when(F.length(text) >= 4000, "long").otherwise("short")
    )


def cells(documents: DataFrame) -> DataFrame:
    """Token mass per (source, lang, topic), missing values as a value of their own, stored."""
    rows = documents.select(
        F.coalesce("source", F.lit(NONE)).alias("source"), F.coalesce("lang", F.lit(NONE)).alias("lang"),
        topic(F.col("text")).alias("topic"), tokens(F.col("text")).alias("n"),
    )
    return stored(rows.groupBy(*DIMENSIONS).agg(F.sum("n").cast("double").alias("mass")).where("mass > 0"), "cells")


def targets(table: DataFrame, dimension: str) -> DataFrame:
    """The default marginal: shares of the token mass, flattened."""
    sums = table.groupBy(dimension).agg(F.pow(F.sum("mass"), F.lit(FLATTEN)).alias("t"))
    whole = sums.agg(F.sum("t")).first()[0] or 1.0
    return sums.select(dimension, (F.col("t") / whole).alias("target"))


def within_reach(table: DataFrame, name: str, target: DataFrame) -> DataFrame:
    """The cells with ``<name>_target``: each value's target, lowered to what its cells can give (``most``).

    What lowered targets leave goes to the other values in proportion, until none is too high.
    Values without a target get none, and targets of values without cells go to the rest.
    """
    values = table.groupBy(name).agg(F.sum("most").alias("reach")).join(target.select(name, "target"), name)
    values = stored(values.withColumn("full", F.col("reach") <= 0), "targets")
    while True:
        given, left = values.agg(
            F.sum(F.when(F.col("full"), F.col("reach"))), F.sum(F.when(~F.col("full"), F.col("target")))
        ).first()
        factor = max(0.0, 1.0 - (given or 0.0)) / left if left else 0.0
        wanted = F.when(F.col("full"), F.col("reach")).otherwise(F.col("target") * factor)
        over = ~F.col("full") & (wanted > F.col("reach") * (1 + 1e-12))
        if not values.where(over).limit(1).count():
            break
        values = stored(values.withColumn("full", F.col("full") | over), "targets")
    return table.join(values.select(name, wanted.alias(f"{name}_target")), name)


def misses(raked: DataFrame, name: str) -> DataFrame:
    """Target and weight of each value of a dimension, and how far they are apart."""
    sums = raked.groupBy(name).agg(F.max(f"{name}_target").alias("target"), F.sum("weight").alias("weight"))
    return sums.withColumn("miss", F.abs(F.col("weight") - F.col("target")))


def rake(table: DataFrame, marginals: dict[str, DataFrame], budget: float | None = None) -> DataFrame:
    """The cells with ``weight``, which sums to the target share over each value of a dimension.

    With a ``budget``, no weight exceeds the cell's share of the tokens over it (``most``), so that
    the budget can be drawn without taking a document twice. Targets out of reach are lowered
    (``within_reach``). Where targets cannot all be met together, raking ends when the largest miss
    no longer shrinks, and says so in the log; ``misses`` tells all of them.
    """
    whole = table.agg(F.sum("mass")).first()[0] or 1.0
    bound = F.col("mass") / (whole * budget) if budget else F.lit(float("inf"))
    now = table.withColumns({"weight": F.col("mass") / whole, "most": bound})
    for name, target in marginals.items():
        now = within_reach(now, name, target)
    last = float("inf")
    while True:
        for _ in range(SWEEPS):
            for name in marginals:
                total = F.sum("weight").over(Window.partitionBy(name))  # a value's cells: a few per topic
                fitted = F.when(total > 0, F.col("weight") * F.col(f"{name}_target") / total).otherwise(0.0)
                now = now.withColumn("weight", F.least(fitted, "most"))
        now = stored(now, "raked")
        miss = max([misses(now, name).agg(F.max("miss")).first()[0] or 0.0 for name in marginals], default=0.0)
        if miss <= TOLERANCE:
            return now
        if miss > last * PROGRESS:
            log.warning("targets cannot all be met together: the largest miss is %.4f of all tokens", miss)
            return now
        last = miss


def probabilities(raked: DataFrame, budget: float = BUDGET) -> DataFrame:
    """``keep`` per cell: its weight of the token budget over its mass; at most 1 by ``most``."""
    mass = raked.agg(F.sum("mass")).first()[0] or 0.0
    return raked.select(*DIMENSIONS, F.least(F.col("weight") * mass * budget / F.col("mass"), F.lit(1.0)).alias("keep"))


def draw(documents: DataFrame, marginals: dict[str, DataFrame] | None = None, budget: float = BUDGET) -> DataFrame:
    """The sampled documents with all their columns and ``__keep__``, the probability used.

    Whether a document stays depends on its doc_id and text only, so repeated rows stay or go
    together. Documents without words have no mass and always stay; so do those of cells without a
    target. An empty frame stays empty. Columns may have any names but that one.
    """
    table = cells(documents)
    raked = rake(table, marginals or {d: targets(table, d) for d in DIMENSIONS}, budget)
    chosen = probabilities(raked, budget).withColumnsRenamed({d: f"of_{d}" for d in DIMENSIONS})
    rows = documents.select(
        F.struct("*").alias("whole"),
        F.coalesce("source", F.lit(NONE)).alias("of_source"), F.coalesce("lang", F.lit(NONE)).alias("of_lang"),
        topic(F.col("text")).alias("of_topic"),
        (F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit("mix")), 11) / F.lit(float(1 << 53))).alias("place"),
    )
    joined = rows.join(chosen, [f"of_{d}" for d in DIMENSIONS], "left").withColumn("keep", F.coalesce("keep", F.lit(1.0)))
    return joined.where(F.col("place") < F.col("keep")).select("whole.*", F.col("keep").alias("__keep__"))
