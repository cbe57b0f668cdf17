"""I-Match fingerprints over several randomised lexicons.

A text's distinct terms are kept if their document frequency in the corpus lies within a band:
rare terms change with every typo, common ones tell nothing apart. The kept terms, sorted, are
hashed once per lexicon, each of which has a random part of all terms: eighteen families of five
nested lexicons with a quarter down to a 1024th of the terms. Sparse lexicons still agree where
texts differ much, dense ones only where they differ little, so agreeing hashes measure
likeness. A family agrees somewhere about as often as a random term of either text is in both, so
that of texts which share half their terms (a third of all) one in 1,500 agrees in none.
Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.corpus import id_and_text, utf8_sha256
from orderlens.workspace import stored

#: The band of document frequency, as parts of the number of documents (idf 2.3 to 7.6).
LEAST_SHARE, MOST_SHARE = 1 / 2000, 1 / 10
FAMILIES, RATES, STRIDE = 18, (2, 4, 6, 8, 10), 10
#: Families that take their bits from one hash of a term; the next ones hash it again.
PER_HASH = 6
LEXICONS = FAMILIES * len(RATES)
DIGITS = 8
EMPTY = "0" * DIGITS
#: Bits of the band's Bloom filter: so many per term, between these powers of two.
BITS_PER_TERM, LEAST_POWER, MOST_POWER = 32, 16, 23

#: Ids are dealt to buckets of this power of two for finding each document's next.
BUCKET_POWER = 6


def terms(text: str) -> str:
    """SQL: the sorted hashes of a text's distinct lower-case runs of letters and digits."""
    words = rf"split(lower({text}), '[^\\p{{L}}\\p{{N}}]+')"
    return f"sort_array(array_remove(array_distinct(transform({words}, w -> xxhash64(w))), xxhash64('')))"


def band(documents: DataFrame) -> DataFrame:
    """The corpus terms whose document frequency lies within the band, stored.

    Counted over all rows. There are at most ``1 / LEAST_SHARE`` times as many as a document
    has distinct terms on average, however large the corpus.
    """
    rows = id_and_text(documents)
    n = rows.count()
    counted = rows.select(F.explode(F.expr(terms("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    return stored(
        counted.where((F.col("n") >= LEAST_SHARE * n) & (F.col("n") <= max(MOST_SHARE * n, 1))).select("term"),
        "lexicon",
    )


def _nested(terms: str, level: int = 0) -> str:
    """SQL: hashes of the terms within the lexicons of masks ``m``, densest first, each taken from the one before."""
    left = len(RATES) - level
    if not left:
        return "''"
    own = f"s{level}"
    digits = f"lpad(hex(shiftrightunsigned(xxhash64({own}), {64 - 4 * DIGITS})), {DIGITS}, '0')"
    return (
        f"transform(array(filter({terms}, t -> (t & m.m{level}) = 0)), {own} -> if(size({own}) = 0, '{EMPTY * left}',"
        f" concat({digits}, {_nested(own, level + 1)})))[0]"
    )


def _hashed(terms: str) -> str:
    """SQL: the digits of all families, over the terms, their hashes, the hashes' hashes and so on.

    One expression serves all families, which differ in the masks that it runs over; written out
    for each, it takes hundreds of MB in the driver.
    """
    masks = [[((1 << rate) - 1) << STRIDE * family for rate in RATES] for family in range(PER_HASH)]
    masks = ", ".join(
        "named_struct({})".format(", ".join(f"'m{level}', {mask}L" for level, mask in enumerate(own))) for own in masks
    )
    rounds = -(-FAMILIES // PER_HASH)
    keys = "array({})".format(", ".join(f"k{i}" for i in range(rounds)))
    for i in reversed(range(1, rounds)):
        keys = f"transform(array(transform(k{i - 1}, t -> xxhash64(t))), k{i} -> {keys})[0]"
    keys = f"transform(array({terms}), k0 -> {keys})[0]"
    digits = f"flatten(transform({keys}, k -> transform(array({masks}), m -> {_nested('k')})))"
    return f"array_join(slice({digits}, 1, {FAMILIES}), '')"


class Fingerprinter:
    """Fingerprints relative to a band of terms.

    The band is held as a Bloom filter of at most 2 ** MOST_POWER bits: at 32 bits a term, one
    in 250 other terms passes as well. It passes in every text alike, so that equal texts keep
    equal fingerprints.
    """

    def __init__(self, lexicon: DataFrame) -> None:
        size = lexicon.count()
        self.power = min(MOST_POWER, max(LEAST_POWER, (BITS_PER_TERM * size - 1).bit_length() if size else 0))
        probes = lexicon.select(F.explode(F.array(*(F.expr(p) for p in self._probes("term")))).alias("bit"))
        words = probes.groupBy(F.shiftright("bit", 6).alias("word")).agg(
            F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("bits")
        )
        table = [0] * (1 << self.power - 6)
        for row in words.collect():  # at most 2 ** (MOST_POWER - 6) rows
            table[row["word"]] = row["bits"]
        self.table = "[" + ",".join(map(str, table)) + "]"

    def _probes(self, term: str) -> tuple[str, str]:
        return (
            f"shiftrightunsigned({term}, {64 - self.power})",
            f"shiftrightunsigned(xxhash64({term}), {64 - self.power})",
        )

    def kept(self, text: str) -> str:
        """SQL: the text's terms within the band, or all its terms if none is."""
        tests = " and ".join(
            f"(shiftrightunsigned(lexicon[cast(shiftright({p}, 6) as int)], cast({p} & 63 as int)) & 1) = 1"
            for p in self._probes("t")
        )
        # transform over one element names a value, so that it is computed once
        return (
            f"transform(transform(array({terms(text)}), all -> struct(all, filter(all, t -> {tests}))),"
            " x -> if(size(x.col2) > 0, x.col2, x.all))"
        )

    def fingerprints(self, rows: DataFrame, **texts: str) -> DataFrame:
        """Adds a fingerprint column for each named text column; missing texts get null."""
        prints, lexicon = "__prints__", F.from_json(F.lit(self.table), "array<bigint>")
        # one expression for all texts: it holds the whole table, and every printed plan what it holds
        hashed = F.expr(
            f"transform(__texts__, text -> if(text is null, null,"
            f" transform(array(__lexicon__), lexicon -> {_hashed(f'{self.kept("text")}[0]')})[0]))"
        )
        found = rows.withColumn("__texts__", F.array(*texts.values())).withColumn("__lexicon__", lexicon).withColumn(prints, hashed)
        return found.select(*rows.columns, *(F.col(prints)[i].alias(name) for i, name in enumerate(texts)))


def likeness(one: str, other: str) -> Column:
    """Likeness (0 to 1) of two fingerprints; 1 for equal ones, also of texts without terms.

    The mean of two shares: of all lexicons with terms of either text, those that hash them
    alike; and of all families, those that do so in their sparsest such lexicon, which happens
    about as often as a random term of either text is in both.
    """
    empty, levels = f"cast('{EMPTY}' as binary)", len(RATES)
    # per lexicon: 0 without terms, 1 not alike, 2 alike; as bytes, so that no part is counted off from the start
    codes = (
        f"transform(array(struct(cast({one} as binary) as a, cast({other} as binary) as b)), p ->"
        f" transform(sequence(0, {LEXICONS - 1}), i -> transform(array(struct(substring(p.a, i * {DIGITS} + 1, {DIGITS}) as a,"
        f" substring(p.b, i * {DIGITS} + 1, {DIGITS}) as b)), x -> if(x.a = x.b, if(x.a = {empty}, 0, 2), 1))[0]))[0]"
    )
    own = f"slice(codes, family * {levels} + 1, {levels})"

    def share(least: int) -> tuple[str, str]:
        """SQL: the number of lexicons with this code or a higher one, and of families with such a lexicon."""
        return (
            f"size(filter(codes, c -> c >= {least}))",
            f"size(filter(sequence(0, {FAMILIES - 1}), family -> exists({own}, c -> c >= {least})))",
        )

    # nested: lexicons that agree on a dense level agree on the sparser ones too
    (some, families), (same, alike) = share(1), share(2)
    shares = f"{same} / greatest({some}, 1) + {alike} / greatest({families}, 1)"
    shares = F.expr(f"transform(array({codes}), codes -> {shares})[0]")
    return F.when(F.col(one) == F.col(other), 1.0).otherwise(shares / 2)


def in_buckets(rows: DataFrame) -> DataFrame:
    """The rows (doc_id, text) by buckets of ids, each with a guest: the row that follows its last.

    Rows follow one another by descending doc_id, nulls last; the first follows the last.
    Only ids are shuffled to find the guests, and no more than one id of each bucket is ordered.
    """
    bucket = F.coalesce(F.shiftright("doc_id", BUCKET_POWER), F.lit(-(1 << 60)))
    rows = rows.withColumn("bucket", bucket)
    tops = stored(rows.groupBy("bucket").agg(F.max("doc_id").alias("top")), "id-buckets")
    wide = F.shiftright("bucket", 12)
    starts = tops.groupBy(wide.alias("wide")).agg(F.min("bucket").alias("start"))
    along = Window.orderBy("wide")  # one row for 2 ** 18 ids
    following = starts.select("wide", F.lead("start").over(along).alias("after"))
    links = tops.withColumn("wide", wide).withColumn("to", F.lead("bucket").over(Window.partitionBy("wide").orderBy("bucket")))
    lowest = tops.agg(F.min("bucket")).first()[0]
    links = links.join(following, "wide").select("top", F.coalesce("to", "after", F.lit(lowest)).alias("to"))
    guests = rows.join(links, F.col("doc_id").eqNullSafe(F.col("top"))).select(
        "doc_id", "text", F.col("to").alias("bucket"), F.lit(True).alias("guest")
    )
    return rows.select("doc_id", "text", "bucket", F.lit(False).alias("guest")).unionByName(guests)


def with_next(documents: DataFrame) -> DataFrame:
    """Every document with its fingerprint, its edited text's and the next document's.

    The edited text has the last floor(n / 2) code points replaced by the first as many (or
    all) of the next document, by descending doc_id, after the last the first. A missing text
    counts as empty; a text without terms has the empty fingerprint. Of rows with equal doc_id
    the one with the smaller hash comes first; each row is returned once.
    """
    rows = id_and_text(documents)
    prints = Fingerprinter(band(documents))
    order = Window.partitionBy("bucket").orderBy(
        "guest", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text"
    )
    paired = in_buckets(rows).withColumn("next_text", F.lead("text").over(order))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = paired.withColumn("n_chars", F.length("text").cast("long")).withColumn(
        "edited",
        F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half)),
    )
    done = prints.fingerprints(edited, fingerprint="text", edited_fingerprint="edited").withColumn(
        "edited_sha256", utf8_sha256(F.col("edited"))
    )
    done = done.withColumn("next_fingerprint", F.lead("fingerprint").over(order)).where("not guest")
    return done.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )
