"""Benchmark decontamination by templates.

Numbers, names and units become typed placeholders, so that a question with other parameters
keeps its template. Windows of template words are joined by hash between documents and benchmark
items, and compared word by word; per alignment (document and item at one distance) the slots must
be consistent, one value of the item for one value of the document and the other way round.
Built-in functions only.

A document's windows are held against a bitmap of the benchmark's before they become rows, and those
that pass take their words along, so that texts are read once and never shuffled. Every window holds
a run of words that starts at a multiple of STEP in the document; windows whose run no window of the
benchmark has are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.workspace import stored

#: Template words per window; an item of fewer words is one window.
WINDOW = 8
#: Items of fewer words than this are only found as whole documents: anything may hold them by chance.
SHORTEST = 5
#: A document's runs of words are tried at so many words' distance. Less than SHORTEST.
STEP = 4
#: Bits of a bitmap: at least eight for each window or run of the benchmark, up to this many.
MOST_BITS = 1 << 20
#: Part of an item's windows that a document must hold in consistent alignments.
LEAST_SHARE = 0.3

# Common units of measurement and currency.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb oz ml l s min h hr hour hours minute minutes second seconds day days"
    " year years meter meters metre metres mile miles gram grams liter liters dollar dollars euro euros cent cents"
    " usd eur percent degrees"
).split()

_PLAIN = r"regexp_replace({t}, '^[^\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}%]+$', '')"
_NUMBER = r"'^[+-]?[0-9][0-9.,:/]*%?$'"


def _templates(text: str) -> str:
    """SQL: the text's words as structs of template word (t) and original word (o).

    Comparisons of first and last characters spare most words the patterns: a number starts below
    ``:``, a name with a capital, and a word of plain letters at both ends needs no trimming.
    """
    units = ", ".join(f"'{u}'" for u in UNITS)
    plain = (
        "if(w >= 'a' and w < '{' and substr(w, -1) >= 'a' and substr(w, -1) < '{', w, " + _PLAIN.format(t="w") + ")"
    )
    number = "({w}.o < ':' and {w}.o rlike " + _NUMBER + ")"
    capital = "(w.o < '[' or w.o >= '\u0080')"
    return (
        f"transform(array(filter(transform(split({text}, '[ \\t\\n\\f\\r\\u000b]+'), w -> struct(w as raw, {plain} as o)), w -> w.o != '')),"
        f" ws -> transform(ws, (w, i) -> struct(case when {number.format(w='w')} then '#number'"
        f" when i > 0 and {number.format(w='ws[i - 1]')} and lower(w.o) in ({units}) then '#unit'"
        rf" when i > 0 and {capital} and w.o rlike '^\\p{{Lu}}\\p{{Ll}}+$' and not ws[i - 1].raw rlike '[.!?:|]$' then '#name'"
        " else lower(w.o) end as t, lower(w.o) as o)))[0]"
    )


def item_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, item_at, width, window and item_words of every window of the items, stored.

    An item under WINDOW words is one window of all its words.
    """
    words = benchmark.select("item_id", F.expr(_templates("coalesce(text, '')")).alias("words")).where(F.size("words") > 0)
    width = F.least(F.size("words"), F.lit(WINDOW))
    rows = words.select(
        "item_id", width.alias("width"), "words", F.explode(F.sequence(F.lit(0), F.size("words") - width)).alias("item_at")
    )
    cut = rows.select("item_id", "item_at", "width", F.expr("slice(words, item_at + 1, width)").alias("item_words"))
    return stored(cut.withColumn("window", F.expr("xxhash64(item_words.t)")), "benchmark-windows")


def _known(hashes: DataFrame, value: str) -> str:
    """SQL: whether a bitmap of the column ``hash`` holds the value; others pass at times."""
    bits = 1024
    while bits < min(MOST_BITS, 8 * hashes.count()):
        bits *= 2
    words = [0] * (bits // 32)
    for row in hashes.select(F.pmod("hash", F.lit(bits)).alias("bit")).distinct().collect():  # at most ``bits`` rows
        words[row.bit // 32] |= 1 << row.bit % 32
    table = f"array({', '.join(f'{w}L' for w in words)})"
    return f"shiftright({table}[cast(pmod({value}, {bits}) div 32 as int)], cast(pmod({value}, 32) as int)) & 1L = 1L"


def _document_windows(items: DataFrame) -> str:
    """SQL: structs (doc_at, window, doc_words) of the text's windows that the benchmark may have.

    Windows are of the widths that items have, from SHORTEST on; a text of fewer words is one window.
    """
    widths = {r["width"] for r in items.select("width").distinct().collect()} | {WINDOW}  # at most WINDOW
    widths = sorted(w for w in widths if w >= SHORTEST)
    run = widths[0] - STEP + 1
    runs = items.where(f"width >= {SHORTEST}").select(
        F.explode(F.expr(f"transform(sequence(1, {STEP}), i -> xxhash64(slice(item_words.t, i, {run})))")).alias("hash")
    )
    tried = f"filter(sequence(1, size(b.t) - {run - 1}, {STEP}), i -> {_known(runs.distinct(), f'xxhash64(slice(b.t, i, {run}))')})"
    starts = f"flatten(transform({tried}, i -> sequence(greatest(1, i - {STEP - 1}), i)))"
    spots = (
        f"if(size(b.t) < {SHORTEST}, array(struct(1 as i, size(b.t) as k, xxhash64(b.t) as window)),"
        f" transform(array({starts}), starts -> flatten(transform(array({', '.join(map(str, widths))}), k -> transform("
        "filter(starts, i -> i <= size(b.t) - k + 1), i -> struct(i, k, xxhash64(slice(b.t, i, k)) as window)))))[0])"
    )
    known = _known(items.select(F.col("window").alias("hash")), "s.window")
    return (
        f"transform(transform(array({_templates('text')}), ws -> struct(ws as ws, ws.t as t)), b -> if(size(b.t) = 0,"
        " array(), transform(filter(" + spots + f", s -> {known}),"
        " s -> struct(s.i - 1 as doc_at, s.window as window, slice(b.ws, s.i, s.k) as doc_words))))[0]"
    )


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_windows (of the item's, found), item_windows and share of every leak.

    A missing or empty text has no windows. An item of SHORTEST to WINDOW words is found anywhere, a
    shorter one only as a whole document. Rows with equal doc_id count as one document, and
    items with equal item_id as one item; rows without an id take part in no leak. Long texts are
    windowed whole. Without items or documents there are no leaks; other columns are ignored.
    """
    items = item_windows(benchmark.where("item_id is not null"))
    texts = documents.where("doc_id is not null").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    hits = texts.select("doc_id", F.explode(F.expr(_document_windows(items))).alias("hit")).select("doc_id", "hit.*")
    pairs = hits.join(items, "window").where(F.expr("doc_words.t = item_words.t"))
    slots = pairs.select(
        "doc_id", "item_id", (F.col("doc_at") - F.col("item_at")).alias("shift"), "window",
        F.expr(
            "transform(filter(arrays_zip(item_words, doc_words), z -> z.item_words.t like '#%'),"
            " z -> struct(z.item_words.o as item_value, z.doc_words.o as doc_value))"
        ).alias("slots"),
    )
    slots = stored(slots.distinct(), "template-slots")
    alignment = ["doc_id", "item_id", "shift"]
    values = slots.select(*alignment, F.explode("slots").alias("slot")).select(*alignment, "slot.*")

    def clash(one: str, other: str) -> DataFrame:
        spread = values.groupBy(*alignment, one).agg(F.min(other).alias("least"), F.max(other).alias("most"))
        return spread.where("least <> most").select(*alignment)

    clashes = clash("item_value", "doc_value").union(clash("doc_value", "item_value")).distinct()
    sizes = items.groupBy("item_id").agg(F.count_distinct("window").alias("item_windows"))
    held = (
        slots.join(clashes, alignment, "left_anti")
        .select("doc_id", "item_id", "window").distinct().groupBy("doc_id", "item_id").agg(F.count("*").alias("n_windows"))
    )
    return (
        held.join(sizes, "item_id").withColumn("share", F.col("n_windows") / F.col("item_windows"))
        .where(F.col("share") >= LEAST_SHARE).select("doc_id", "item_id", "n_windows", "item_windows", "share")
    )


def keep_clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without those that leak an item; rows without doc_id stay."""
    leaking = leaks(documents, benchmark).select(F.col("doc_id").alias("leaking_id")).distinct()
    rows = documents.select(F.struct("*").alias("whole"), F.col("doc_id").alias("own_id"))
    return rows.join(leaking, F.col("own_id") == F.col("leaking_id"), "left_anti").select("whole.*")
