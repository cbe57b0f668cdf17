"""Sharding by histogram sort: splitters from exact byte counts, then one exchange.

Rows are ordered by two 63-bit keys, the hash of their group and the hash of their id. Each
round counts, over all partitions, the exact bytes in bins of the key range that still holds
a splitter, and narrows the range twelve bits further, until every splitter's byte count is
within the tolerance of its target. Where a group lies across a target, the splitter goes to the
nearer end of it, so that its rows stay together; only a group above WHOLE of a shard's share is cut,
by the second key in the same way.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.workspace import stored

KEY_BITS, STEP_BITS = 63, 12
#: How far a splitter's bytes may be from its target, as a part of a shard's share.
TOLERANCE = 0.002
#: Groups up to this part of a shard's share stay whole, and move a splitter by half as much at most.
WHOLE = 0.03

GROUP, TIE, SIZE, SHARD, AT = "__group__", "__tie__", "__size__", "__shard__", "__at__"


@dataclass(frozen=True)
class Splitter:
    """The first key of the next shard; keys that are too large for any row end the range."""

    group: int
    tie: int

    def reached(self) -> Column:
        top = (1 << KEY_BITS) - 1
        if self.group > top:
            return F.lit(False)
        above = F.col(GROUP) > self.group
        if self.tie > top:
            return above
        return above | ((F.col(GROUP) == self.group) & (F.col(TIE) >= self.tie))


@dataclass
class _Search:
    target: int
    prefix: int = 0
    below: int = 0
    group: int | None = None  # the hot group within which it goes on
    found: Splitter | None = None


def _key(value: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(value), 1)


def _narrow(searches: list[_Search], bins: dict, shift: int, tolerance: float, whole: float) -> list[_Search]:
    """Place the splitters that this round's bins decide; returns those whose group is hot."""
    hot = []
    for s in searches:
        at, last = s.below, None
        for prefix, size, rows, low, high in bins[s.group, s.prefix]:
            last = prefix
            if at + size > s.target:
                break
            at += size
        else:
            size = rows = 0
            prefix, low, high = (last + 1 if last is not None else 0), 0, 1

        def edge(number: int) -> Splitter:
            value = number << shift
            return Splitter(value, 0) if s.group is None else Splitter(s.group, value)

        lower, upper = s.target - at, at + size - s.target
        one = low == high and s.group is None and size <= whole
        if min(lower, upper) <= tolerance or one or rows <= 1 or shift == 0 and (s.group is not None or low != high):
            s.found = edge(prefix) if lower <= upper else edge(prefix + 1)
        elif low == high and s.group is None:
            s.group, s.prefix, s.below = low, 0, at
            hot.append(s)
        else:
            s.prefix, s.below = prefix, at
    return hot


def _count(rows: DataFrame, searches: list[_Search], key: str, shift: int, before: int) -> dict:
    """Bytes, rows and group range per bin, at most 2 ** STEP_BITS bins for each open range."""
    wanted = {(s.group, s.prefix) for s in searches}
    groups = sorted({g for g, _ in wanted if g is not None})
    open_rows = rows.where(F.col(GROUP).isin(groups)) if groups else rows
    if before < KEY_BITS:
        open_rows = open_rows.where(F.shiftrightunsigned(key, before).isin(sorted({p for _, p in wanted})))
    owner = F.col(GROUP) if groups else F.lit(None).cast("long")
    counted = (
        open_rows.groupBy(owner.alias("owner"), F.shiftrightunsigned(key, shift).alias("bin"))
        .agg(F.sum(SIZE).alias("size"), F.count("*").alias("rows"), F.min(GROUP).alias("low"), F.max(GROUP).alias("high"))
        .collect()
    )
    bins: dict = {w: [] for w in wanted}
    for r in sorted(counted, key=lambda r: r["bin"]):
        place = (r["owner"], r["bin"] >> (before - shift))
        if place in bins:
            bins[place].append((r["bin"], r["size"], r["rows"], r["low"], r["high"]))
    return bins


def splitters(rows: DataFrame, shards: int, tolerance: float = TOLERANCE, whole: float = WHOLE) -> list[Splitter]:
    """The ``shards - 1`` splitters of stored rows (GROUP, TIE, SIZE)."""
    total = rows.agg(F.sum(SIZE)).first()[0] or 0
    searches = [_Search(total * i // shards) for i in range(1, shards)]
    slack, whole = tolerance * total / shards, whole * total / shards
    hot: list[_Search] = []
    for key, level in ((GROUP, searches), (TIE, hot)):
        before = KEY_BITS
        while (going := [s for s in level if s.found is None and (s.group is None or key == TIE)]) and before:
            shift = max(0, before - STEP_BITS)
            hot += _narrow(going, _count(rows, going, key, shift, before), shift, slack, whole)
            before = shift
    return [s.found for s in searches]


def shard(rows: DataFrame, size: Column, group: Column, tie: Column, shards: int) -> DataFrame:
    """The rows, all columns kept, with ``shard`` and ``slot`` (replaced if already there).

    ``size`` are whole bytes, at least 1. Shards hold near equal bytes; slots count up from 0
    within each. Rows of a group share a shard unless the group exceeds WHOLE of a shard's bytes.
    Rows with equal group and tie, as repeated rows have, stay next to each other
    and are never parted, nulls are keys like others, and an empty frame stays empty. Columns may
    have any names.
    """
    spark = rows.sparkSession
    keyed = rows.select(F.struct("*").alias("whole"), _key(group).alias(GROUP), _key(tie).alias(TIE), size.cast("long").alias(SIZE))
    bounds = splitters(stored(keyed.select(GROUP, TIE, SIZE), "shard-keys"), shards)
    number = reduce(lambda a, b: a + b, (s.reached().cast("int") for s in bounds), F.lit(0))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = stored(
        keyed.withColumn(SHARD, number).drop(SIZE)
        .repartitionByRange(parts, SHARD, GROUP, TIE).sortWithinPartitions(SHARD, GROUP, TIE)
        .withColumn(AT, F.monotonically_increasing_id()).drop(GROUP, TIE),
        "shards",
    )
    # the number's low 33 bits count a partition's rows in order, the rest is the partition
    part = F.shiftrightunsigned(AT, 33).alias("part")
    runs = placed.groupBy(SHARD, part).agg(F.min(AT).alias("start"), F.count("*").alias("n"))
    before = Window.partitionBy(SHARD).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        F.col(SHARD).alias("__of__"), F.col("part").alias("__part__"),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("start")).alias("__shift__"),
    )  # at most a row per partition and one more per shard
    kept = [F.col(f"whole.`{c}`").alias(c) for c in rows.columns if c not in ("shard", "slot")]
    return placed.join(
        F.broadcast(offsets), (F.col(SHARD) == F.col("__of__")) & (F.shiftrightunsigned(AT, 33) == F.col("__part__"))
    ).select(*kept, F.col(SHARD).alias("shard"), (F.col(AT) + F.col("__shift__")).alias("slot"))
