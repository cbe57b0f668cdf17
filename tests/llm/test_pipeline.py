"""The pipeline's stages, each on what the one before it kept."""

from __future__ import annotations

import corpus_pipeline
import pyarrow as pa
from pairs import odd_rows, shingles, words
from pyspark.sql import functions as F

from orderlens import workspace
from orderlens.llm import decontamination, jaccard_join, language_id, mixing

DATA = "/root/testdata/sf0.001"


def ids(frame):
    return {r["doc_id"] for r in frame.select("doc_id").collect()}


def test_each_stage_decides_over_all_that_came_in(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, benchmark = docs.columns, spark.read.parquet(f"{DATA}/benchmark.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        given, docs = docs, corpus_pipeline.stored(stage(spark, docs, DATA), name)
        out[name] = docs
        assert ids(docs) <= ids(given) and docs.count() > 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    source = spark.read.parquet(f"{DATA}/documents.parquet")
    assert ids(out["language"]) == ids(language_id.keep_identified(source))
    assert ids(out["language"]) >= ids(source.where(F.length("text") > 200))
    sets = {r["doc_id"]: shingles(r["text"]) for r in out["language"].collect()}
    kept = sorted(ids(out["near_duplicates"]))

    def linked(a, b):
        return bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])

    assert not any(linked(a, b) for a in kept for b in kept if a < b)
    assert all(any(linked(a, b) for b in sets if b != a) for a in set(sets) - set(kept))
    leaking = ids(decontamination.leaks(out["near_duplicates"], benchmark))
    assert ids(out["decontamination"]) == set(kept) - leaking
    assert ids(out["mixing"]) == ids(mixing.draw(out["decontamination"]))
    last = out["sharding"]
    assert last.columns == [*columns, "shard", "slot"] and ids(last) == ids(out["mixing"])
    slots = {}
    for r in last.collect():
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and max(slots) < corpus_pipeline.SHARDS
    again = corpus_pipeline.run(spark, DATA)
    assert sorted(map(tuple, again.select("doc_id", "shard", "slot").collect())) == sorted(map(tuple, last.select("doc_id", "shard", "slot").collect()))


def test_stages_take_nulls_copies_and_columns_of_any_name(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, whole string, own_id long, keep int, of_lang string, later_id int"
    rows = [(i, t, None if k % 3 else "en", "s" if k % 4 else None, None, "w", 5, 1, "x", 2) for k, (i, t) in enumerate(odd_rows())]
    full, none = spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, full, DATA)
        assert [c for c in kept.columns if c not in ("shard", "slot")] == full.columns, name
        # a missing lang may be filled in
        assert set(map(tuple, kept.select(full.columns).drop("lang").collect())) <= {r[:2] + r[3:] for r in rows}, name
        assert stage(spark, none, DATA).collect() == [], name


def batch_sizes(session, docs, sf_dir):
    def sizes(batches):
        for batch in batches:
            yield batch.append_column("size", pa.array([len(batch)] * len(batch), pa.int64())).select(["doc_id", "size"])

    return docs.select("doc_id").mapInArrow(sizes, "doc_id long, size long")


def test_texts_go_to_python_in_small_batches_in_every_stage(spark, monkeypatch, tmp_path):
    texts = spark.createDataFrame([(i, f"text {i}") for i in range(3000)], "doc_id long, text string").coalesce(1)
    texts.write.parquet(str(tmp_path / "documents.parquet"))

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("first", batch_sizes), ("second", batch_sizes)])
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.count() == 3000 and got.agg(F.max("size")).first()[0] <= 512
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_the_language_stage_has_small_batches_whoever_reads_its_result(spark, monkeypatch):
    texts = spark.createDataFrame([(i, f"text {i}") for i in range(3000)], "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(language_id, "keep_identified", lambda docs: batch_sizes(spark, docs, ""))
    got = dict(corpus_pipeline.STAGES)["language"](spark, texts, "")
    assert got.count() == 3000 and got.agg(F.max("size")).first()[0] <= 512


def test_a_passage_of_many_texts_does_not_make_them_one_family(spark, monkeypatch):
    given = {}

    def stored(frame, label):
        given[label] = workspace.stored(frame, label)
        return given[label]

    monkeypatch.setattr(jaccard_join, "stored", stored)
    passage, rows = words(0, 100), []
    for k in range(6):
        own = words(k + 1, 100)
        rows += [(2 * k, " ".join(own + passage)), (2 * k + 1, " ".join([*own[:50], "changed", *own[51:], *passage]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert ids(dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, "")) == set(range(0, 12, 2))
    families = given["families"].groupBy("family").count().collect()
    assert [r["count"] for r in families] == [2] * 6
