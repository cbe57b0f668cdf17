"""Repeated runs of lines, found by prefix doubling over line names.

Every line gets a name (a hash of its text), and doubling names runs of 2, 4, 8, ... lines by the names
of their halves, until no name is found twice. Only positions whose name is found twice go into the
next round: a run can only repeat if both its halves do. Positions that share a name are the interval
of the suffix array of all line sequences with that common prefix; its first position, by doc_id and
place, is the copy that stays. Each position's widest interval is kept, and the runs of a text that
touch are joined to the stretches that go.

Halves lie in one text: up to the least length that counts, doubling is arithmetic on a row's own
lines; from there on names meet by text, and only names and positions are shuffled, the text once, to
meet its cuts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.corpus import id_and_text, utf8_sha256
from orderlens.workspace import stored

#: Runs of 2 ** ROUNDS lines and longer count; doubling goes on from there until names are unique.
ROUNDS = 1

LINES = "split(text, '\\\\n', -1)"


def run_names(documents: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, text_key, at, name) of every run of 2 ** rounds lines that are not all blank, stored."""
    names = f"transform({LINES}, line -> xxhash64(line))"
    for level in range(rounds):
        step = 1 << level
        names = (
            f"transform(array({names}), n -> if(size(n) <= {step}, array(),"
            f" transform(sequence(1, size(n) - {step}), i -> xxhash64(n[i - 1], n[i + {step - 1}]))))[0]"
        )
    width = 1 << rounds
    runs = documents.select(
        "doc_id", "text_key", F.expr(f"transform({LINES}, line -> trim(line) = '')").alias("blank"), F.expr(names).alias("names")
    )
    runs = runs.select("doc_id", "text_key", "blank", F.posexplode("names").alias("at", "name"))
    said = F.expr(f"exists(slice(blank, at + 1, {width}), b -> not b)")
    return stored(runs.where(said).select("doc_id", "text_key", "at", "name").distinct(), "line-runs")


def _repeated(names: DataFrame) -> DataFrame:
    """The rows whose name is found more than once, with the first place that has it, stored."""
    place = F.struct("doc_id", "text_key", "at")
    first = names.groupBy("name").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    return stored(names.join(first.drop("n"), "name"), "repeated-lines")


def _doubled(repeated: DataFrame, width: int) -> DataFrame:
    """Names of runs of 2 * width lines whose halves are both found more than once, stored."""
    ahead = Window.partitionBy("doc_id", "text_key").orderBy("at").rangeBetween(width, width)
    pairs = repeated.withColumn("half", F.first("name").over(ahead)).where("half is not null")
    return stored(pairs.select("doc_id", "text_key", "at", F.xxhash64("name", "half").alias("name")), "line-runs")


def intervals(documents: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, text_key, at, width, first) by doubled width, from 2 ** rounds until names are unique.

    A row says that the ``width`` lines at a position are also found elsewhere, and where first. Wider
    runs are doubled from halves that are not all blank.
    """
    names, width, found = run_names(documents, rounds), 1 << rounds, []
    while not found or not names.isEmpty():
        repeated = _repeated(names)
        found.append(repeated.select("doc_id", "text_key", "at", F.lit(width).alias("width"), "first"))
        names, width = _doubled(repeated, width), 2 * width
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every


def later_stretches(documents: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, text_key, start, stop): lines in runs that begin earlier as well, touching runs joined."""
    same = (F.col("doc_id") == F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    later = intervals(documents, rounds).where(~same | (F.col("at") - F.col("first.at") >= F.col("width")))
    own = Window.partitionBy("doc_id", "text_key").orderBy("at")
    runs = later.groupBy("doc_id", "text_key", "at").agg(F.max(F.col("at") + F.col("width")).alias("stop"))
    reach = F.max("stop").over(own.rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("new", F.coalesce((F.col("at") > reach).cast("int"), F.lit(1)))
    runs = runs.withColumn("stretch", F.sum("new").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("doc_id", "text_key", "stretch").agg(F.min("at").alias("start"), F.max("stop").alias("stop")).drop("stretch")


def drop_repeated_runs(documents: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_lines, n_removed and kept_text of every row.

    A line goes if a run of 2 ** rounds lines over it, not all of them blank, also begins earlier: in a
    smaller doc_id, or further up in the same text without overlapping it (of six equal lines the
    first run stays whole). Of texts that share a doc_id the one with the smaller hash comes first;
    rows that share the text as well count as one, and each is returned. A missing text counts as
    empty and has one empty line. Lines end at ``\\n`` only. Rows without doc_id are left as they are.
    Long texts are taken whole, and an empty table gives an empty result; other columns are ignored.
    """
    rows = id_and_text(documents).withColumn("text_key", F.xxhash64("text"))
    dropped = later_stretches(rows.where("doc_id is not null"), rounds).groupBy(
        F.col("doc_id").alias("of_doc"), F.col("text_key").alias("of_text")
    ).agg(F.flatten(F.collect_list(F.sequence("start", F.col("stop") - 1))).alias("covered"))
    gone = rows.join(dropped, (F.col("doc_id") == F.col("of_doc")) & (F.col("text_key") == F.col("of_text")), "left")
    gone = gone.withColumns({"lines": F.expr(LINES), "covered": F.coalesce("covered", F.array().cast("array<int>"))})
    left = "array_except(sequence(0, size(lines) - 1), covered)"
    kept = F.when(F.size("covered") == 0, F.col("text")).otherwise(
        F.expr(f"array_join(transform({left}, i -> lines[i]), '\\n')")
    )
    return gone.select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"), F.size("covered").cast("long").alias("n_removed"),
        kept.alias("kept_text"),
    )


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_lines", "n_removed", utf8_sha256(F.col("kept_text")).alias("kept_sha256"))
