"""Language identification with a bit-sliced Bloom filter of character n-grams.

Each slot of one fixed-size table holds a bit mask over languages; an n-gram's languages are
the AND of the masks at its slots, so a single look-up answers for all languages at once.
A text's language is the one with the largest share of the text's n-grams, after the share
that chance hits in that language's bit slice would give has been taken off.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.corpus import fold

UNDETERMINED = "und"
SLOT_BITS = 18
CHUNK_CHARS = 1 << 18
#: N-grams are this many letters long; a word's ends count as letters.
GRAM = 4
#: Labelled texts that are learned from, per language; all rows are predicted.
MAX_TRAINING_TEXTS = 20_000
#: A language's filter has the n-grams found in this share of its training texts or more.
LEAST_SHARE = 1 / 400
#: And at least this part of the share in the language where it is most common.
RELATIVE_SHARE = 1 / 3

_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class LanguageFilter:
    """``masks[slot]`` has bit i % 64 of word i // 64 set for language i."""

    languages: tuple[str, ...]
    masks: np.ndarray  # words x slots, uint64
    chance: np.ndarray  # by language: the share of unknown n-grams that its slice claims


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of the texts as 64-bit hashes, and the index of the text of each.

    Every run of characters other than letters is one word end; n-grams lie within
    ``end word end``, and words shorter than that give one n-gram.
    """
    texts = [t.lower() for t in texts]
    points = np.frombuffer(
        ("\0" * GRAM).join([*texts, ""]).encode("utf-32-le", "replace"), dtype=np.uint32
    )
    letter = _letters()[points]
    owner = np.zeros(len(points), np.int64)
    lengths = np.array([len(t) for t in texts], np.int64)
    owner[np.cumsum(lengths[:-1] + GRAM)] = 1  # where the second text begins, and so on
    owner = np.cumsum(owner)
    previous = np.concatenate(([False], letter[:-1]))
    keep = letter | previous  # the letters and one end after each word
    points, owner = np.where(letter, points, 0)[keep], owner[keep]
    if not len(points):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # an end before the first word of each text comes from the end of the word before
    hashed = np.zeros(len(points), np.uint64)
    padded = np.concatenate((np.zeros(1, np.uint32), points, np.zeros(GRAM, np.uint32)))
    open_ = np.ones(len(points), bool)
    with np.errstate(over="ignore"):
        for i in range(GRAM):
            part = padded[i : i + len(points)]
            if i > 1:
                open_ &= padded[i - 1 : i - 1 + len(points)] != 0
            hashed = hashed * np.uint64(0x100000001B3) + np.where(open_, part, 0).astype(np.uint64)
        hashed ^= hashed >> np.uint64(29)
        hashed *= np.uint64(0xBF58476D1CE4E5B9)
        hashed ^= hashed >> np.uint64(32)
    starts_in_word = padded[1 : 1 + len(points)] != 0
    return hashed[starts_in_word], owner[starts_in_word]


def slots(hashed: np.ndarray) -> list[np.ndarray]:
    with np.errstate(over="ignore"):
        return [((hashed * np.uint64(m)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64) for m in _MIX]


def _chunks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Neighbouring texts of about CHUNK_CHARS together, with the index of the first."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > CHUNK_CHARS:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, texts[first:]


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        texts = [t or "" for t in batch.column("text").to_pylist()]
        for first, part in _chunks(texts):
            hashed, owner = grams(part)
            if not len(hashed):
                continue
            order = np.lexsort((hashed, owner))
            hashed, owner = hashed[order], owner[order]
            new = np.concatenate(([True], (hashed[1:] != hashed[:-1]) | (owner[1:] != owner[:-1])))
            hashed, owner = hashed[new], owner[new]
            own = np.array([langs[first + i] for i in range(len(part))], object)
            for lang in set(own.tolist()):
                values, counts = np.unique(hashed[own[owner] == lang], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(values), pa.string()), pa.array(values.view(np.int64)), pa.array(counts)],
                    names=["lang", "gram", "n"],
                )


def learn(examples: DataFrame) -> LanguageFilter:
    """The filter learned from rows with text and lang; rows without either teach nothing.

    At most MAX_TRAINING_TEXTS texts per language are used, chosen by a hash of the text. The
    number of n-grams that pass LEAST_SHARE is bounded by 1 / LEAST_SHARE times the mean number
    of a text's n-grams, whatever the input, and the table of slots by 2 ** SLOT_BITS.
    """
    examples = examples.where("lang is not null and text is not null").select("text", "lang")
    sizes = {r["lang"]: r["n"] for r in examples.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = tuple(sorted(sizes))
    words = (len(languages) + 63) // 64 or 1
    masks = np.zeros((words, 1 << SLOT_BITS), np.uint64)
    if not languages:
        return LanguageFilter((), masks, np.zeros(0))
    taken = F.lit(False)
    for lang, n in sizes.items():
        share = min(1.0, MAX_TRAINING_TEXTS / n)
        taken = taken | ((F.col("lang") == lang) & (F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(share * (1 << 20))))
    counted = (
        examples.where(taken)
        .mapInArrow(_gram_counts, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    least = F.lit(2.0)
    for lang, n in sizes.items():
        least = F.when(F.col("lang") == lang, F.lit(max(1.0, min(n, MAX_TRAINING_TEXTS) * LEAST_SHARE))).otherwise(least)
    known = counted.where(F.col("n") >= least).toPandas()
    known["share"] = known["n"] / known["lang"].map(sizes).clip(upper=MAX_TRAINING_TEXTS)
    known = known[known["share"] >= RELATIVE_SHARE * known.groupby("gram")["share"].transform("max")]
    place = {lang: i for i, lang in enumerate(languages)}
    for lang, group in known.groupby("lang"):
        i = place[lang]
        for slot in slots(group["gram"].to_numpy().view(np.uint64)):
            masks[i // 64, slot] |= np.uint64(1) << np.uint64(i % 64)
    fill = np.array([
        ((masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(languages))
    ])
    return LanguageFilter(languages, masks, fill ** len(_MIX))


def shares(texts: list[str], model: LanguageFilter) -> tuple[np.ndarray, np.ndarray]:
    """By text and language: the share of n-grams found, corrected for chance hits; and the number of n-grams."""
    found = np.zeros((len(texts), len(model.languages)))
    total = np.zeros(len(texts))
    for first, part in _chunks(texts):
        hashed, owner = grams(part)
        total[first : first + len(part)] = np.bincount(owner, minlength=len(part))
        at = slots(hashed)
        for word in range(len(model.masks)):
            hits = np.bitwise_and.reduce([model.masks[word][s] for s in at])
            for i in range(word * 64, min(word * 64 + 64, len(model.languages))):
                bit = (hits >> np.uint64(i % 64)) & np.uint64(1)
                found[first : first + len(part), i] = np.bincount(owner, bit, minlength=len(part))
    share = found / np.maximum(total, 1)[:, None]
    return np.maximum(0, (share - model.chance) / np.maximum(1e-9, 1 - model.chance)), total


def predictor(spark: SparkSession, model: LanguageFilter):
    """A column function: text to (lang_pred, score), see ``predict``."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def told(texts: pd.Series) -> pd.DataFrame:
        learned = shared.value
        share, total = shares([t or "" for t in texts], learned)
        known = (total > 0) & bool(learned.languages)
        best, score = np.zeros(len(total), int), np.zeros(len(total))
        if learned.languages:
            best = share.argmax(axis=1)
            top = share[np.arange(len(best)), best]
            score = np.where(known, top / np.maximum(share.sum(axis=1), 1e-12), 0.0)
        names = [learned.languages[i] if k else UNDETERMINED for i, k in zip(best, known)]
        return pd.DataFrame({"lang_pred": names, "score": score})

    return told


def predict(documents: DataFrame, model: LanguageFilter) -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) of every row, from its whole text only.

    The score is the leading language's corrected share over the sum of all. A missing text or
    one without letters is ``und`` with score 0, and so is every text if nothing was learned;
    a text with none of the known n-grams is the first language in order, with score 0. Equal
    shares go to the first language in order. Repeated rows each get their own result.
    """
    told = predictor(documents.sparkSession, model)
    return documents.select("doc_id", told("text").alias("told")).select("doc_id", "told.*")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id, 4) == 2, F.lit(False))


def learn_from_folds(documents: DataFrame) -> LanguageFilter:
    """The filter learned from the rows that are not held out."""
    return learn(documents.where(~held_out(F.col("doc_id"))))


def keep_identified(documents: DataFrame) -> DataFrame:
    """The documents without those whose language cannot be told (``und``).

    Learned from the documents' own lang. A missing ``lang`` is filled with the predicted one;
    all columns stay.
    """
    told = predictor(documents.sparkSession, learn_from_folds(documents))
    verdict = "__language_told__"
    filled = F.coalesce("lang", F.col(verdict).lang_pred).alias("lang")
    return (
        documents.withColumn(verdict, told("text"))
        .where(F.col(verdict).lang_pred != UNDETERMINED)
        .select(*(filled if c == "lang" else F.col(c) for c in documents.columns))
    )
