"""Exact similarity self-join of documents on the Jaccard index of their word shingles.

1. Texts with equal sets are one set from here on, with a name of 128 bits, and one row of it, by id
   and text, lends its text.
2. Shingles are counted over all sets. Each set's prefix in the order (count, hash; counts over 128
   in steps) must share a shingle with every set it links with, so that sets with a quarter of
   shingles of their own have no partner.
3. Sets that share a prefix shingle, directly or in turn, make a family.
4. Each family is joined set by set. Index lists are sorted by size, and the blocks whose sizes
   or positions leave too little to share are skipped at once; a set whose component is known to
   be the candidate's is not compared; and the distance to the set that a candidate was linked
   to bounds its own, so that answers of a similar set rule out most others.
   Families too large for one task are dealt to pairs of blocks.
5. The links found (at most one per set and task) give components.

Links between different sets are all found: the order of shingles only decides how long it takes.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.corpus import id_and_text, sliced, small_batches
from orderlens.llm.links import components
from orderlens.llm.word_sets import set_name, shingle_sets
from orderlens.workspace import stored

#: Jaccard threshold as a fraction.
NUMERATOR, DENOMINATOR = 3, 4
OFTEN = 16
LEAST_POWER, MOST_POWER = 20, 27
TOKEN_BITS = 44
FLUSH = 1 << 19
#: Sets of a block of tokens are numbered in two bytes.
MOST_OWNERS = 1 << 16
ROW_HASHES = 4
#: What one task joins: so many sets and bytes of text at most (a single set may be larger).
BLOCK_SETS, BLOCK_BYTES = 4096, 12 << 20


def prefix_length(n: int) -> int:
    return n - -(-NUMERATOR * n // DENOMINATOR) + 1 if n else 0


def _found(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The shingle set of every text of a batch."""
    return shingle_sets(batch.column("text").cast(pa.binary()).to_pylist())


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        n, keys = [], []
        for hashes in _found(batch):
            n.append(len(hashes))
            keys.append(set_name(hashes))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(n, pa.int64()), pa.array(keys, pa.binary())],
            names=["doc_id", "text_key", "n_shingles", "set_key"],
        )


def sets(documents: DataFrame) -> DataFrame:
    """doc_id, text_key, n_shingles and set_key of every row, stored."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.withColumn("text_key", F.xxhash64("text"))
    return stored(
        rows.mapInArrow(_sets, f"doc_id {kind}, text_key long, n_shingles long, set_key binary"), "shingle-sets"
    )


def _packed(values: np.ndarray) -> bytes:
    """Sorted numbers as differences, the bytes of equal weight together (they compress well)."""
    return np.diff(values, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _token_counts(bucket_bits: int, arrays: Callable[[pa.RecordBatch], Iterator[np.ndarray]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            tokens, counts = np.unique(np.concatenate(held) >> np.uint64(64 - TOKEN_BITS), return_counts=True)
            bucket = (tokens >> np.uint64(TOKEN_BITS - bucket_bits)).astype(np.int64)
            starts = np.flatnonzero(np.diff(bucket, prepend=-1))
            ends = np.append(starts[1:], len(tokens))
            few = np.minimum(counts, 255).astype(np.uint8)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket[starts]),
                    pa.array([_packed(tokens[a:b]) for a, b in zip(starts, ends)], pa.binary()),
                    pa.array([few[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                ],
                names=["bucket", "tokens", "counts"],
            )

        for batch in sliced(batches):
            for hashes in arrays(batch):
                if len(hashes):
                    held.append(hashes)
                    size += len(hashes)
                if size >= FLUSH:
                    yield flush()
                    held.clear()
                    size = 0
        if held:
            yield flush()

    return run


def common_hashes(
    documents: DataFrame, expected: int, arrays: Callable[[pa.RecordBatch], Iterator[np.ndarray]] = _found
) -> tuple[int, np.ndarray]:
    """Bits per slot (2 ** power slots): found more than once (1), found often (2).

    Counted over all rows. The bitmap has 16 slots per expected hash as far as MOST_POWER allows, so
    that its size is bounded; a fuller one makes prefixes less selective, never wrong.
    """
    power = min(MOST_POWER, max(LEAST_POWER, (16 * expected).bit_length()))
    bucket_bits = min(16, max(8, (expected >> 20).bit_length()))

    def region(group: pa.Table) -> pa.Table:
        tokens = np.concatenate([_unpacked(x.as_py()) for x in group.column("tokens")])
        counts = np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in group.column("counts")]).astype(np.int64)
        order = np.argsort(tokens, kind="stable")
        tokens, counts = tokens[order], counts[order]
        starts = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
        total = np.add.reduceat(counts, starts)
        slot = (tokens[starts] >> np.uint64(TOKEN_BITS - power)).astype(np.int64)
        bucket = group.column("bucket")[0].as_py()
        width = 1 << power - bucket_bits
        local = slot - bucket * width
        bits = [np.packbits(np.bincount(local[total >= least], minlength=width) > 0) for least in (2, OFTEN)]
        return pa.table({"bucket": pa.array([bucket]), **{f"b{i}": pa.array([b.tobytes()]) for i, b in enumerate(bits)}})

    regions = (
        documents.select("text").mapInArrow(_token_counts(bucket_bits, arrays), "bucket long, tokens binary, counts binary")
        .groupBy("bucket").applyInArrow(region, "bucket long, b0 binary, b1 binary")
    )
    size = 1 << power - 3
    bitmap = np.zeros((2, size), np.uint8)
    part = size >> bucket_bits
    for row in stored(regions, "common-hashes").toLocalIterator():  # 2 ** power bits twice, in bounded pieces
        for i in (0, 1):
            bitmap[i, row["bucket"] * part : (row["bucket"] + 1) * part] = np.frombuffer(row[f"b{i}"], np.uint8)
    return power, bitmap


def lending_rows(reps: DataFrame) -> tuple[int, np.ndarray]:
    """A Bloom filter of 2 ** power bits, 64 to a word, of the rows that lend their set's text.

    A row that it doesn't hold surely lends nothing; of those it holds, a few do not either. Its size
    is bounded; a fuller one lets more copies through, never fewer.
    """
    power = min(MOST_POWER, max(LEAST_POWER, (16 * reps.count()).bit_length()))
    words = (
        reps.select(F.explode(row_slots(F.col("row.doc_id"), F.col("row.text_key"), power)).alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(slot & 63 AS INT)))").alias("bits"))
    )
    found, bitmap = words.toArrow(), np.zeros(1 << power - 6, np.int64)
    bitmap[found["word"].to_numpy()] = found["bits"].to_numpy()
    return power, bitmap


def row_slots(doc_id: Column, text_key: Column, power: int) -> Column:
    return F.array(*(F.shiftrightunsigned(F.xxhash64(doc_id, text_key, F.lit(i)), 64 - power) for i in range(ROW_HASHES)))


def _dealt_tokens(bucket_bits: int, lends: Callable[[np.ndarray], np.ndarray]):
    """Sets in blocks: a row of tokens and their owners per bucket, and one of names and sizes (bucket below 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, blocks = [], 0, itertools.count(TaskContext.get().partitionId() << 32)

        def flush() -> pa.RecordBatch:
            block, sizes = next(blocks), np.array([len(hashes) for hashes in held], np.int64)
            tokens = np.concatenate(held) >> np.uint64(64 - TOKEN_BITS)
            order = np.argsort(tokens, kind="stable")
            tokens, owners = tokens[order], np.repeat(np.arange(len(held), dtype=np.uint16), sizes)[order]
            bucket = (tokens >> np.uint64(TOKEN_BITS - bucket_bits)).astype(np.int64)
            starts = np.flatnonzero(np.diff(bucket, prepend=-1))
            ends = np.append(starts[1:], len(tokens))
            names = b"".join(set_name(hashes) for hashes in held)
            return _token_rows(
                np.full(len(starts) + 1, block),
                np.append(bucket[starts], ~block),
                [_packed(tokens[a:b]) for a, b in zip(starts, ends)] + [names],
                [_planes(owners[a:b]) for a, b in zip(starts, ends)] + [sizes.tobytes()],
                [b""] * (len(starts) + 1),
            )

        for batch in sliced(batches):
            slots = batch.column("slots").flatten().to_numpy().reshape(-1, ROW_HASHES)
            lent = batch.filter(pa.array(lends(slots)))
            for hashes in _found(lent):
                if len(hashes):
                    held.append(hashes)
                    size += len(hashes)
                if size >= FLUSH or len(held) == MOST_OWNERS:
                    yield flush()
                    held.clear()
                    size = 0
        if held:
            yield flush()

    return run


TOKEN_ROWS = "block long, bucket long, tokens binary, owners binary, counts binary"


def _token_rows(block, bucket, tokens: list[bytes], owners: list[bytes], counts: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(block, pa.int64()), pa.array(bucket, pa.int64()), *(pa.array(x, pa.binary()) for x in (tokens, owners, counts))],
        names=["block", "bucket", "tokens", "owners", "counts"],
    )


def _planes(owners: np.ndarray) -> bytes:
    """The low bytes, then the high ones."""
    return owners.view(np.uint8).reshape(-1, 2).T.tobytes()


def _owners(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(2, -1).T).view(np.uint16).ravel()


def count_code(found: np.ndarray) -> np.ndarray:
    """Counts in one byte that keeps their order: as they are up to 128, then eight steps to a doubling."""
    return np.minimum(np.where(found <= 128, found, 128 + 8 * np.log2(np.maximum(found, 128) / 128)), 255).astype(np.uint8)


def _repeated(group: pa.Table) -> pa.Table:
    """Of a bucket's tokens those found more than once, with codes of their counts; names and sizes as they come."""
    if group.column("bucket")[0].as_py() < 0:
        return group
    parts = [_unpacked(x.as_py()) for x in group.column("tokens")]
    tokens = np.concatenate(parts)
    order = np.argsort(tokens, kind="stable")
    starts = np.flatnonzero(np.concatenate(([True], np.diff(tokens[order]) != 0)))
    found = np.diff(np.append(starts, len(tokens)))
    counts = np.empty(len(tokens), np.uint8)
    counts[order] = np.repeat(count_code(found), found)
    rows, at = [], 0
    for part, block, owners in zip(parts, group.column("block").to_pylist(), group.column("owners")):
        own = counts[at : at + len(part)]
        at += len(part)
        often = own > 1
        if often.any():
            rows.append((block, _packed(part[often]), _planes(_owners(owners.as_py())[often]), own[often].tobytes()))
    bucket = np.full(len(rows), group.column("bucket")[0].as_py())
    return pa.Table.from_batches([_token_rows([r[0] for r in rows], bucket, *([r[i] for r in rows] for i in (1, 2, 3)))])


def _prefixes(group: pa.Table) -> pa.Table:
    """(token, set_key) of a block's prefix shingles that are found more than once."""
    described = group.filter(pc.less(group.column("bucket"), 0))
    names, sizes = described.column("tokens")[0].as_py(), np.frombuffer(described.column("owners")[0].as_py(), np.int64)
    rows = group.filter(pc.greater_equal(group.column("bucket"), 0)).to_pylist()
    tokens = np.concatenate([np.zeros(0, np.uint64), *(_unpacked(r["tokens"]) for r in rows)])
    owners = np.concatenate([np.zeros(0, np.uint16), *(_owners(r["owners"]) for r in rows)])
    counts = np.frombuffer(b"".join(r["counts"] for r in rows), np.uint8)
    shared = np.bincount(owners, minlength=len(sizes))
    # what a set has alone comes first in its prefix
    left = sizes - -(-NUMERATOR * sizes // DENOMINATOR) + 1 - (sizes - shared)
    order = np.lexsort((tokens, counts, owners))
    place = np.arange(len(order)) - np.repeat(np.cumsum(shared) - shared, shared)
    kept = order[place < np.repeat(left, shared)]
    keys = [names[16 * k : 16 * k + 16] for k in owners[kept].tolist()]
    return pa.table({"token": pa.array(tokens[kept].view(np.int64)), "set_key": pa.array(keys, pa.binary())})


def prefix_entries(documents: DataFrame, reps: DataFrame, expected: int) -> DataFrame:
    """(token, set_key) of every prefix shingle that more than one set has.

    Tokens travel to their bucket with the number of their set in a block of sets; those found more
    than once travel back to the block with their counts, so that what is known of them is exact
    whatever their number. A row that repeats a lending row counts besides it; its set may get
    entries that no other set has.
    """
    power, bitmap = lending_rows(reps)
    shared = documents.sparkSession.sparkContext.broadcast(bitmap)
    bucket_bits = min(16, max(8, (expected >> 20).bit_length()))

    def lends(slots: np.ndarray) -> np.ndarray:
        return ((shared.value[slots >> 6] >> (slots & 63)) & 1 > 0).all(axis=1)

    return (
        documents.select(row_slots(F.col("doc_id"), F.xxhash64("text"), power).alias("slots"), "text")
        .mapInArrow(_dealt_tokens(bucket_bits, lends), TOKEN_ROWS)
        .groupBy("bucket").applyInArrow(_repeated, TOKEN_ROWS)
        .groupBy("block").applyInArrow(_prefixes, "token long, set_key binary")
    )


def link_block(hashes: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links (i, j) that give the components of these sets; at most one less than sets.

    Sets are taken by size; each is compared with smaller ones that share a prefix shingle and
    that it isn't connected with yet.
    """
    order = sorted(range(len(hashes)), key=lambda i: len(hashes[i]))
    by_size = [hashes[i] for i in order]
    sizes = np.array([len(h) for h in by_size], np.int64)
    every = np.concatenate(by_size) if by_size else np.zeros(0, np.uint64)
    values, inverse, counts = np.unique(every, return_inverse=True, return_counts=True)
    ends = np.cumsum(sizes)
    prefixes = []
    token, holder, place = [], [], []
    for i, n in enumerate(sizes):
        own = inverse[ends[i] - n : ends[i]]
        prefix = own[np.lexsort((own, counts[own]))][: prefix_length(int(n))]
        keep = np.flatnonzero(counts[prefix] > 1)
        prefixes.append((prefix[keep], keep))
        token.append(prefix[keep])
        holder.append(np.full(len(keep), i))
        place.append(keep)
    token, holder, place = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (token, holder, place))
    listed = np.lexsort((holder, token))
    token, holder, place = token[listed], holder[listed], place[listed]

    root = np.arange(len(sizes))
    pivot, off = np.arange(len(sizes)), np.zeros(len(sizes))
    links = []

    def shared(i: int, j: int) -> int:
        return len(np.intersect1d(by_size[i], by_size[j], assume_unique=True))

    for x, n in enumerate(sizes):
        if not n:
            continue
        smallest = np.searchsorted(sizes, -(-NUMERATOR * n // DENOMINATOR))
        found = []
        for t, at in zip(*prefixes[x]):
            lo, hi = np.searchsorted(token, [t, t + 1])
            # the list is sorted by size: skip the block of sets too small, stop at x itself
            lo += np.searchsorted(holder[lo:hi], smallest)
            hi = lo + np.searchsorted(holder[lo:hi], x)
            y = holder[lo:hi]
            left = np.minimum(n - at, sizes[y] - place[lo:hi])
            need = -(-(n + sizes[y]) * NUMERATOR // (NUMERATOR + DENOMINATOR))
            found.append(y[left >= need])
        if not found:
            continue
        rest, often = np.unique(np.concatenate(found), return_counts=True)
        rest = rest[np.argsort(-often, kind="stable")]
        distance: dict[int, float] = {}

        def compare(y: int) -> bool:
            both = shared(x, y)
            either = int(n + sizes[y]) - both
            distance[y] = 1 - both / either
            return DENOMINATOR * both >= NUMERATOR * either

        while len(rest := rest[root[rest] != root[x]]):
            y = int(rest[0])
            p = int(pivot[y])
            if p != y and p not in distance and p != x:
                compare(p)
            if p in distance:
                limit = 1 - NUMERATOR / DENOMINATOR + 1e-9
                far = (pivot[rest] == p) & (np.abs(distance[p] - off[rest]) > limit) & (rest != p)
                rest = rest[~far]
                if not len(rest) or rest[0] != y:
                    continue
            rest = rest[1:]
            if y in distance and DENOMINATOR * (1 - distance[y]) < NUMERATOR - 1e-9:
                continue
            if compare(y):
                links.append((order[x], order[y]))
                if pivot[x] == x:
                    pivot[x], off[x] = (p, distance[p]) if p in distance else (y, distance[y])
                root[root == root[x]] = root[y]
    return links


def _join_block(group: pd.DataFrame) -> pd.DataFrame:
    keys = group["set_key"].tolist()
    links = link_block(list(shingle_sets([t.encode() for t in group["text"]])))
    return pd.DataFrame({"a": [keys[i] for i, _ in links], "b": [keys[j] for _, j in links]})


def _components(documents: DataFrame) -> DataFrame:
    """doc_id, text_key, n_shingles and component_id of every row of (doc_id, text)."""
    with small_batches(documents.sparkSession):
        return _linked(documents, sets(documents))


def _linked(documents: DataFrame, all_sets: DataFrame) -> DataFrame:
    named = all_sets.where("n_shingles > 0").groupBy("set_key").agg(
        F.min("doc_id").alias("first_id"), F.min(F.struct("doc_id", "text_key")).alias("row"), F.max("n_shingles").alias("n")
    )
    reps = stored(named, "shingle-reps")
    total = reps.agg(F.sum("n")).first()[0] or 0
    entries = stored(prefix_entries(documents, reps, total), "shingle-prefixes")
    heads = entries.groupBy("token").agg(F.min("set_key").alias("head"), F.max("set_key").alias("last")).where("head < last")
    pairs = entries.join(heads, "token").where("set_key <> head").select(F.col("set_key").alias("a"), F.col("head").alias("b"))
    families = stored(components(pairs.distinct()).select(F.col("node").alias("set_key"), F.col("root").alias("family")), "families")

    chosen = reps.join(families, "set_key").select(
        "set_key", "family", F.col("row.doc_id").alias("of_doc"), F.col("row.text_key").alias("of_text")
    )
    texts = documents.withColumn("text_key", F.xxhash64("text"))
    texts = stored(
        texts.join(chosen, texts["doc_id"].eqNullSafe(chosen["of_doc"]) & (texts["text_key"] == chosen["of_text"]))
        .select("set_key", "family", "text").dropDuplicates(["set_key"]),
        "family-texts",
    )
    extent = texts.groupBy("family").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum(F.octet_length("text")) / BLOCK_BYTES)).cast("int").alias("blocks")
    )
    dealt = texts.join(extent, "family").withColumn("own", F.pmod(F.xxhash64("set_key"), "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        "family", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "set_key", "text"
    )
    links = dealt.groupBy("family", "i", "j").applyInPandas(_join_block, "a binary, b binary")
    roots = components(links)

    grouped = reps.join(roots, reps["set_key"] == roots["node"], "left").select(
        "set_key", F.coalesce("root", "set_key").alias("root"), "first_id"
    )
    least = grouped.groupBy("root").agg(F.min("first_id").alias("least_id"))
    membership = grouped.join(least, "root").select("set_key", "least_id")
    component = F.when(F.col("n_shingles") > 0, F.col("least_id")).otherwise(F.col("doc_id"))
    return all_sets.join(membership, "set_key", "left").select(
        "doc_id", "text_key", "n_shingles", component.alias("component_id")
    )


def join(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id connected by links) of every row.

    Missing texts and texts without words have no shingles and link with nothing, not even each
    other; a text of fewer than five words is one shingle. Rows of equal sets, as repeated rows,
    are linked; rows that share a doc_id but not the text are set apart by their texts. A row without
    doc_id counts for its set's links but never names a component; if none of a component has an id,
    its component_id is null. Long texts are shingled in pieces, cut between words. An empty table
    gives an empty result; other columns are ignored.
    """
    return _components(id_and_text(documents)).drop("text_key")


def keep_first(documents: DataFrame) -> DataFrame:
    """The rows of documents without those that a near duplicate with a smaller doc_id stands for.

    Of repeated rows with that doc_id all stay; so do rows without doc_id. Rows are told apart by id
    and text, so that of two texts under one id each stays or goes by its own likeness.
    """
    later = _components(id_and_text(documents)).where(F.col("doc_id") > F.col("component_id"))
    later = later.select(F.col("doc_id").alias("later_id"), F.col("text_key").alias("later_text")).distinct()
    rows = documents.select(
        F.struct("*").alias("whole"), F.col("doc_id").alias("own_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("own_text")
    )
    same = (F.col("own_id") == F.col("later_id")) & (F.col("own_text") == F.col("later_text"))
    return rows.join(later, same, "left_anti").select("whole.*")
