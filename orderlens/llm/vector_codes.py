"""Vectors compressed to one byte per part, by distances tabulated over value dictionaries.

Each batch of whole-number vectors is written over one dictionary per dimension, the distinct
integers found there. For a codebook, the squared differences of every dictionary value to the
component of every entry are tabulated once; the distance of a part to all entries is then the sum
of one table row per dimension, gathered by dictionary code. No difference is computed twice, and
everything is whole-number arithmetic, so that results do not depend on partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.integer_vectors import GroupSums, matrix, summed, usable, whole
from orderlens.workspace import stored

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Rows whose distances to all entries are held at a time.
BLOCK = 1024
#: Value ranges up to here get their dictionary by marking instead of sorting.
DENSE = 1 << 20


def dictionary(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and each row's place among them."""
    low, high = int(column.min()), int(column.max())
    if high - low >= DENSE:
        return np.unique(column, return_inverse=True)
    there = np.zeros(high - low + 1, bool)
    there[column - low] = True
    return np.flatnonzero(there) + low, (np.cumsum(there) - 1)[column - low]


def nearest(values: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry number and squared distance of every part of every row; ties go to the lower entry.

    ``books`` is (parts, entries, part width), whole numbers like ``values``.
    """
    parts, entries, width = books.shape
    rows = len(values)
    code, distance = np.zeros((rows, parts), np.int64), np.zeros((rows, parts), np.int64)
    if not rows:
        return code, distance
    far = int(np.abs(values).max()) + int(np.abs(books).max())
    kind = np.int32 if far * far * width < 1 << 31 else np.int64
    for p in range(parts):
        tables, places = [], []
        for d in range(width):
            found, place = dictionary(values[:, p * width + d])
            tables.append(((found[:, None] - books[p, :, d][None, :]) ** 2).astype(kind))
            places.append(place)
        for a in range(0, rows, BLOCK):
            b = min(rows, a + BLOCK)
            total, gathered = np.zeros((b - a, entries), kind), np.empty((b - a, entries), kind)
            for table, place in zip(tables, places):
                np.take(table, place[a:b], axis=0, out=gathered, mode="clip")
                total += gathered
            code[a:b, p] = total.argmin(axis=1)
            distance[a:b, p] = np.take_along_axis(total, code[a:b, p, None], axis=1)[:, 0]
    return code, distance


def _partial_sums(books: np.ndarray):
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [GroupSums(entries, width) for _ in range(parts)]
        for batch in batches:
            values = matrix(batch.column("values"), parts * width)
            code, _ = nearest(values, books)
            for p in range(parts):
                sums[p].add(code[:, p], values[:, p * width : (p + 1) * width])
        for p in range(parts):
            yield sums[p].rows(part=p)

    return run


def common_width(embeddings: DataFrame, parts: int = PARTS) -> int:
    """The most frequent length of usable vectors that divides into the parts (the longer of a tie), or 0."""
    lengths = usable(embeddings).groupBy(F.size("embedding").alias("width")).count()
    lengths = lengths.where((F.col("width") > 0) & (F.col("width") % parts == 0))
    found = lengths.orderBy(F.desc("count"), F.desc("width")).first()
    return found["width"] if found else 0


def learn(vectors: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts, entries, part width) of stored ``vectors`` (vec_id, values).

    They start as the parts of the ``entries`` smallest ids in order (equal ids by their values; rows
    without id start none) and move ``rounds`` times to the floored mean of their parts; entries
    without parts stay. Fewer rows make fewer entries. Driver and tasks hold parts * entries * part
    width numbers, whatever the number of rows.
    """
    first = vectors.where("vec_id is not null").orderBy("vec_id", "values").limit(entries).select("values").collect()
    books = np.array([r["values"] for r in first], np.int64).reshape(len(first), parts, width // parts).transpose(1, 0, 2).copy()
    sums = ", ".join(f"s{d} long" for d in range(width // parts))
    for _ in range(rounds if len(first) else 0):
        partial = vectors.select("values").mapInArrow(_partial_sums(books), f"part long, g long, n long, {sums}")
        for part, entry, n, total in summed(partial, ["part", "g"], width // parts):
            books[part, entry] = [s // n for s in total]
    return books


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error (squared distance over all parts) of every row."""
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}
    width = books.shape[0] * books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, distance = nearest(matrix(batch.column("values"), width), books)
            text = [c.tobytes().hex() for c in code.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(text, pa.string()), pa.array(distance.sum(axis=1), pa.int64())],
                names=["vec_id", "label", "code", "error"],
            )

    return vectors.select("vec_id", "label", "values").mapInArrow(
        run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    )


def decode(codes: DataFrame, books: np.ndarray, scale: int = SCALE) -> DataFrame:
    """vec_id and ``embedding``, the vector that the code stands for, in the units of the input."""
    parts = np.arange(books.shape[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = np.frombuffer(bytes.fromhex("".join(batch.column("code").to_pylist())), np.uint8).reshape(len(batch), len(parts))
            values = books[parts, code] / scale
            rows = pa.array(list(values.reshape(len(batch), -1)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), rows], names=["vec_id", "embedding"])

    kind = codes.schema["vec_id"].dataType.simpleString()
    return codes.select("vec_id", "code").mapInArrow(run, f"vec_id {kind}, embedding array<double>")


def compress(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every usable vector.

    Left out are rows whose vector is null, holds a null or non-finite component, or has not the
    length most usable vectors share (one that divides into the parts, so empty vectors go too).
    Repeated rows and ids are coded row by row; equal labels, nulls together, share a label_error,
    which stops at the largest long. Components beyond +-2 ** 24 / scale count as that bound.
    An empty table gives an empty result. Other columns of the input are ignored.
    """
    width = common_width(embeddings, parts) or parts  # without usable vectors any width will do
    vectors = stored(whole(embeddings, scale, width, "vec_id", "label"), "whole-vectors")
    books = learn(vectors, width, parts, entries, rounds)
    if not books.shape[1]:  # rows without any id have nothing to start from
        vectors = vectors.limit(0)
    coded = stored(encode(vectors, books), "vector-codes")
    most = F.lit(2**63 - 1).cast("decimal(38,0)")
    by_label = coded.groupBy(F.col("label").alias("of_label")).agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), most).cast("long").alias("label_error")
    )
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of_label")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")
    )
