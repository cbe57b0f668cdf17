"""Repeated byte strings across documents, from suffix arrays over anchored windows.

Every window of LEAST bytes has an anchor, the place in it whose next GRAM bytes have the
smallest hash; equal windows have equal anchors. Neighbouring windows with one anchor make a body
of at most 2 * LEAST - GRAM bytes. Bodies whose anchor is found only once hold no repeat; the
others meet by the anchor's hash, where a suffix array of their windows, cut into intervals with
a common prefix of LEAST bytes, gives all occurrences of each repeated string.

Bodies that are equal as a whole are settled by a comparison of ids before the arrays are built.
They meet as digests of 128 bits, half of them the anchor's; only the bytes of those with the smallest
id are cut from their texts and sent. A bucket with too many bodies for one task is spread by window
instead, which gives the same intervals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.corpus import id_and_text, sliced
from orderlens.llm.jaccard_join import common_hashes
from orderlens.workspace import stored

LEAST, GRAM = 50, 24
SPREAD = LEAST - GRAM + 1
PIECE_BITS = 19
#: Bodies that one bucket is meant to have, and has at most before it is spread.
BODIES, MOST_BODIES = 4_000, 40_000
#: A span of bytes lies within one body and is one number, start * REACH + length.
REACH = 128

_BYTE = np.random.default_rng(50).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def bodies(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the first and last window and hash of the anchor of each body.

    ``data`` are the bytes of texts after each other, at most 2 ** PIECE_BITS; ``ends`` where each
    text ends. Windows do not cross ends.
    """
    n = len(data) - LEAST + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    with np.errstate(over="ignore"):
        h, width, parts = _BYTE[data], 1, {}
        while width <= 16:
            parts[width] = h
            if width == 16:
                break
            h = h[:-width] * _power(width) + h[width:]
            width *= 2
        h = parts[16][: len(data) - GRAM + 1] * _power(8) + parts[8][16 : 16 + len(data) - GRAM + 1]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(27)
    low = np.uint64((1 << PIECE_BITS) - 1)
    m = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    for step in (1, 2, 4, 8):
        m = np.minimum(m[:-step], m[step:])
    m = np.minimum(m[: n], m[SPREAD - 16 : SPREAD - 16 + n])
    anchor = (m & low).astype(np.int64)
    starts = np.arange(n)
    text_end = ends[np.searchsorted(ends, starts, side="right")]
    valid = np.flatnonzero(starts + LEAST <= text_end)
    if not len(valid):
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    at = anchor[valid]
    new = np.concatenate(([True], (at[1:] != at[:-1]) | (valid[1:] != valid[:-1] + 1)))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(valid)) - 1
    found = h[at[first]]  # the smallest of many: mixed again to spread over the whole range
    with np.errstate(over="ignore"):
        found = (found ^ (found >> np.uint64(32))) * np.uint64(_BASE)
    return valid[first], valid[last], found ^ (found >> np.uint64(29))


def _pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]]:
    """Bytes, ends and (text, offset) of parts of texts; long texts are cut with LEAST - 1 bytes of overlap."""
    held, where, size, most = [], [], 0, 1 << PIECE_BITS
    for i, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - LEAST + 1), most - LEAST + 1):
            part = text[offset : offset + most]
            if len(part) < LEAST:
                continue
            if size + len(part) > most:
                yield np.frombuffer(b"".join(held), np.uint8), np.cumsum([len(x) for x in held]), where
                held, where, size = [], [], 0
            held.append(part)
            where.append((i, offset))
            size += len(part)
    if held:
        yield np.frombuffer(b"".join(held), np.uint8), np.cumsum([len(x) for x in held]), where


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [x.as_py() or b"" for x in batch.column("text").cast(pa.binary())]


def _anchor_arrays(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for data, ends, _ in _pieces(_texts(batch)):
        yield bodies(data, ends)[2]


def repeated_bodies(documents: DataFrame) -> DataFrame:
    """(bucket, anchor, digest, doc_id, text_key, span) of every body whose anchor is found more than once."""
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    expected = 2 * size // SPREAD
    power, bitmap = common_hashes(documents, expected, _anchor_arrays)
    shared = documents.sparkSession.sparkContext.broadcast(bitmap[0])
    buckets = max(64, expected // 5 // BODIES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            ids, keys = batch.column("doc_id"), batch.column("text_key")
            for data, ends, where in _pieces(_texts(batch)):
                first, last, anchor = bodies(data, ends)
                slot = (anchor >> np.uint64(64 - power)).astype(np.int64)
                known = np.flatnonzero((bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1)
                first, last, anchor = first[known], last[known], anchor[known]
                part = np.searchsorted(ends, first, side="right")
                begin = np.concatenate(([0], ends[:-1]))[part]
                rows = np.array([w[0] for w in where], np.int64)[part]
                offset = np.array([w[1] for w in where], np.int64)[part]
                raw, digest = data.tobytes(), xxhash.xxh3_64_intdigest
                found = [digest(raw[a:b]) for a, b in zip(first.tolist(), (last + LEAST).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor.view(np.int64)),
                        pa.array(np.array(found, np.uint64).view(np.int64)),
                        ids.take(pa.array(rows)),
                        keys.take(pa.array(rows)),
                        pa.array((first - begin + offset) * REACH + last - first + LEAST),
                    ],
                    names=["anchor", "digest", "doc_id", "text_key", "span"],
                )

    found = documents.mapInArrow(run, "anchor long, digest long, doc_id long, text_key long, span long")
    return found.withColumn("bucket", F.pmod("anchor", F.lit(buckets)))


def settled_bodies(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, whole, firsts): spans that a smaller doc_id has as a body, and (span, bucket) of the others."""
    same = Window.partitionBy("anchor", "digest")
    rows = repeated_bodies(documents).withColumn("first_id", F.min("doc_id").over(same))
    mine = F.col("doc_id") == F.col("first_id")
    rows = rows.select("doc_id", "text_key", "span", F.when(mine, F.col("bucket")).alias("bucket"))
    # repeated rows have the same spans, so that a set has them once
    return rows.repartition("doc_id", "text_key").groupBy("doc_id", "text_key").agg(
        F.collect_set(F.when(F.col("bucket").isNull(), F.col("span"))).alias("whole"),
        F.collect_set(F.when(F.col("bucket").isNotNull(), F.struct("span", "bucket"))).alias("firsts"),
    )


def _cut_bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each text's bodies in ``firsts``."""
    for batch in sliced(batches):
        firsts = batch.column("firsts")
        parents, found = firsts.value_parent_indices(), firsts.flatten()
        span = found.field("span").to_numpy()
        at, size, texts = span // REACH, span % REACH, _texts(batch)
        body = [texts[i][a : a + n] for i, a, n in zip(parents.to_pylist(), at.tolist(), size.tolist())]
        yield pa.RecordBatch.from_arrays(
            [
                found.field("bucket"),
                batch.column("doc_id").take(parents),
                batch.column("text_key").take(parents),
                pa.array(at),
                pa.array(body, pa.binary()),
            ],
            names=["bucket", "doc_id", "text_key", "at", "body"],
        )


def repeat_groups(contents: list[bytes], owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The suffix array of all windows of the bodies, and its intervals of common prefix LEAST.

    Returns body, offset, interval number, smallest owner in the interval and whether the interval
    is left-diverse, by rank. An interval whose occurrences all have the same byte before them is
    no maximal repeat: that of one byte further left has the same occurrences.
    """
    lengths = np.array([len(c) for c in contents], np.int64)
    data = np.frombuffer(b"".join(contents) + bytes(8), np.uint8)
    begins = np.cumsum(lengths) - lengths
    windows = lengths - LEAST + 1
    body = np.repeat(np.arange(len(contents)), windows)
    offset = np.arange(len(body)) - np.repeat(np.cumsum(windows) - windows, windows)
    start = begins[body] + offset
    # big-endian words of the prefix, so that order by words is order by bytes
    word = np.zeros(len(data) - 7, np.uint64)
    for i in range(8):
        word = (word << np.uint64(8)) | data[i : i + len(word)]
    columns = [word[start + i] for i in range(0, LEAST - 7, 8)]
    columns.append(word[start + LEAST - 8])  # the last eight bytes overlap the word before
    order = np.lexsort((start, *columns[::-1]))
    cut = np.zeros(len(order), bool)
    cut[:1] = True
    for c in columns:
        s = c[order]
        cut[1:] |= s[1:] != s[:-1]
    heads = np.flatnonzero(cut)
    number = np.cumsum(cut) - 1
    body, offset, start = body[order], offset[order], start[order]
    least = np.minimum.reduceat(owners[body], heads)[number] if len(heads) else owners[:0]
    left = np.where(offset > 0, data[np.maximum(start - 1, 0)].astype(np.int64), -1 - body)
    diverse = (np.minimum.reduceat(left, heads) != np.maximum.reduceat(left, heads))[number] if len(heads) else cut
    return body, offset, number, least, diverse


def _spans(group: pa.Table) -> pa.Table:
    """Byte ranges of the group's bodies that a smaller document has as well."""
    contents = [x.as_py() for x in group.column("body")]
    owners = group.column("doc_id").to_numpy()
    body, offset, _, least, _ = repeat_groups(contents, owners)
    later = np.flatnonzero(owners[body] > least)
    body, offset = body[later], offset[later]
    order = np.lexsort((offset, body))
    body, offset = body[order], offset[order]
    new = np.ones(len(body), bool)
    new[1:] = (body[1:] != body[:-1]) | (offset[1:] != offset[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(body)) - 1 if len(first) else first
    at = group.column("at").to_numpy()[body[first]]
    return pa.table({
        "doc_id": pa.array(owners[body[first]], pa.int64()),
        "text_key": group.column("text_key").take(pa.array(body[first])),
        "span": pa.array((at + offset[first]) * REACH + offset[last] - offset[first] + LEAST, pa.int64()),
    })


def repeated_spans(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, spans): what is covered by strings that a smaller doc_id has as well, one row a text."""
    settled = stored(settled_bodies(documents), "settled-bodies")
    # only the bodies of the smallest ids are looked into; equal ones of others go as a whole
    firsts = documents.join(settled.where(F.size("firsts") > 0).drop("whole"), ["doc_id", "text_key"])
    firsts = stored(
        firsts.mapInArrow(_cut_bodies, "bucket long, doc_id long, text_key long, at long, body binary"), "first-bodies"
    ).where("bucket is not null")  # said once, so that both joins below read one shuffle
    large = firsts.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > MOST_BODIES).select("bucket")
    within = firsts.join(large, "bucket", "left_anti").groupBy("bucket").applyInArrow(
        _spans, "doc_id long, text_key long, span long"
    )
    window = F.explode(F.expr(f"transform(sequence(0, octet_length(body) - {LEAST}), o -> struct(o, substring(body, o + 1, {LEAST}) as w))"))
    spread = firsts.join(large, "bucket").select("doc_id", "text_key", "at", window.alias("x")).select("doc_id", "text_key", (F.col("at") + F.col("x.o")).alias("start"), "x.w")
    spread = spread.withColumn("first_id", F.min("doc_id").over(Window.partitionBy("w"))).where("doc_id > first_id")
    looked = within.unionByName(spread.select("doc_id", "text_key", (F.col("start") * REACH + LEAST).alias("span")))
    looked = stored(looked.groupBy("doc_id", "text_key").agg(F.collect_set("span").alias("looked")), "looked-into")
    # every text with spans has a body, so that it stands in settled
    spans = F.concat("whole", F.coalesce("looked", F.array().cast("array<long>")))
    return settled.join(looked, ["doc_id", "text_key"], "left").select("doc_id", "text_key", spans.alias("spans"))


def cut_out(text: str, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left of a text's bytes, the number removed, and the number of maximal runs removed."""
    raw, kept, at, runs, reach = text.encode("utf-8", "surrogatepass"), [], 0, 0, -1
    for start, stop in sorted(spans):
        if start > reach:
            runs += 1
        if start > at:
            kept.append(raw[at:start])
        at = reach = max(at, stop)
    kept.append(raw[at:])
    left = b"".join(kept)
    return left, len(raw) - len(left), runs


def drop_repeats(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_text and kept_sha256 of every row.

    A byte goes if a string of LEAST bytes over it also starts in a document with a smaller
    doc_id, judged on the input. A missing text counts as empty; texts under LEAST bytes stay.
    Rows with equal doc_id remove nothing from each other, also when their texts differ, and each
    loses what is found in smaller ids; rows without doc_id neither lose bytes nor make others lose
    any. Cuts may fall within a character, so that kept_text is binary. An empty table gives an empty
    result; other columns are ignored.
    """
    rows = id_and_text(documents).withColumn("text_key", F.xxhash64("text"))
    spans = repeated_spans(rows.where("doc_id is not null").withColumn("doc_id", F.col("doc_id").cast("long")))
    by_document = spans.select(F.col("doc_id").alias("of_doc"), F.col("text_key").alias("of_text"), "spans")

    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept_text binary, kept_sha256 string")
    def left(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for text, found in zip(texts, spans):
            pairs = [(x // REACH, x // REACH + x % REACH) for x in found.tolist()] if found is not None else []
            kept, removed, runs = cut_out(text, pairs)
            out.append((len(kept) + removed, removed, runs, kept, hashlib.sha256(kept).hexdigest()))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_text", "kept_sha256"])

    own = (F.col("doc_id") == F.col("of_doc")) & (F.col("text_key") == F.col("of_text"))
    return rows.join(by_document, own, "left").select(
        "doc_id", left("text", "spans").alias("x")
    ).select("doc_id", "x.*")
