"""Corpus operators against brute force on small tables with nulls, empty texts, ties and odd columns."""

from __future__ import annotations

import hashlib
import os
import random
import re
import time

import numpy as np
import pytest
from pairs import expected, odd_rows
from pyspark.sql import functions as F

from orderlens import workspace
from orderlens.llm import (
    decontamination,
    fingerprints,
    jaccard_join,
    language_id,
    line_dedup,
    mixing,
    quality,
    sharding,
    suffix_dedup,
    warc,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket string, name string, root long"


def documents(spark, rows):
    """Rows of (doc_id, text[, lang, source]), with extra columns named like internal ones."""
    full = [(r[0], r[1], *(list(r[2:]) + [None] * 2)[:2], None if r[1] is None else len(r[1]), "x", None, 7) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(words))


@pytest.fixture
def odd(spark):
    """Nulls in every column, empty and blank texts, a long text, copies and repeated rows."""
    base = prose(1, 60)
    near = base.split()
    near[30] = "changed"
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, " ".join(near), "fr", "b"), (4, None, None, None), (5, "", "en", "b"),
        (6, " \n\t", "de", None), (7, prose(2, 3000), "en", "a"), (8, "One two", "fr", "a"), (8, "One two", "fr", "a"),
        (None, prose(3, 40), "de", "c"), (9, prose(4, 50) + "\nl1\nl2\nl3\nl4\nend", "de", "c"),
        (10, "start\nl1\nl2\nl3\nl4\n" + prose(5, 50), "de", "c"), (11, "1234 5678", None, "c"),
    ]
    return documents(spark, rows)


@pytest.fixture
def none(spark):
    return documents(spark, [])


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}


@pytest.mark.parametrize("block", [None, 300])
def test_jaccard_components_match_all_pairs(spark, monkeypatch, block):
    if block:
        monkeypatch.setattr(jaccard_join, "BLOCK_BYTES", block)
    rows = odd_rows()
    got = [tuple(r) for r in jaccard_join.join(documents(spark, rows)).collect()]
    assert sorted(map(str, got)) == sorted(str(r[:3]) for r in expected(rows, 75))


def test_near_duplicates_keep_the_first(odd, none):
    kept = jaccard_join.keep_first(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted("1 4 5 6 7 8 8 9 10 11 None".split())
    assert jaccard_join.keep_first(none).collect() == []
    two = documents(odd.sparkSession, [(1, prose(1, 60)), (5, prose(1, 60)), (5, prose(2, 60)), (6, prose(2, 60))])
    two = two.withColumnsRenamed({"bucket": "later_id", "name": "own_text", "root": "whole"})
    assert sorted((r["doc_id"], r["text"]) for r in jaccard_join.keep_first(two).collect()) == [(1, prose(1, 60)), (5, prose(2, 60))]


@pytest.mark.parametrize(("copies", "most"), [(1, 11), (4, 27)])
def test_sets_without_partner_are_not_dealt(spark, monkeypatch, copies, most):
    """Neither copies nor a great number of shingles found in two texts each give other texts prefix entries."""
    monkeypatch.setattr(jaccard_join, "LEAST_POWER", 10)
    monkeypatch.setattr(jaccard_join, "MOST_POWER", most)
    given = {}

    def stored(frame, label):
        given[label] = workspace.stored(frame, label)
        return given[label]

    monkeypatch.setattr(jaccard_join, "stored", stored)
    texts = [f"{prose(900 + k, 200)} {prose(5000 + k // 2, 25)}" for k in range(400)]
    near = texts[0].split()
    near[100] = "changed"
    rows = [(i, t) for i, t in enumerate([*texts * copies, " ".join(near)])]
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.join(documents(spark, rows)).collect()}
    assert got == {i: 0 if i == len(rows) - 1 else i % 400 for i, _ in rows}
    keys = {bytes(r["set_key"]) for r in given["shingle-prefixes"].collect()}
    assert len(keys) < 20 and given["family-texts"].count() == 2


def test_counts_of_shingles_keep_their_order():
    codes = jaccard_join.count_code(np.array([2, 3, 127, 128, 150, 1000, 2000, 10**6, 10**9])).tolist()
    assert codes == sorted(codes) and codes[:4] == [2, 3, 127, 128] and len(set(codes)) == 9


@pytest.mark.parametrize("most", [40_000, 0])
def test_repeated_strings_match_brute_force(spark, monkeypatch, odd, most):
    monkeypatch.setattr(suffix_dedup, "MOST_BODIES", most)
    rows = {r["doc_id"]: r["text"] or "" for r in odd.collect() if r["doc_id"] is not None}
    rows |= {20: "é" * 20 + rows[7][500:800] + "ß", 21: rows[7][650:700], 22: rows[7][650:699]}
    seen, want = set(), {}
    for i in sorted(rows):
        raw = rows[i].encode()
        cut, own = bytearray(len(raw)), set()
        for p in range(len(raw) - 49):
            own.add(raw[p : p + 50])
            if raw[p : p + 50] in seen:
                cut[p : p + 50] = b"\1" * 50
        seen |= own
        runs = sum(c and (p == 0 or not cut[p - 1]) for p, c in enumerate(cut))
        want[i] = (len(raw), sum(cut), runs, hashlib.sha256(bytes(b for b, c in zip(raw, cut) if not c)).hexdigest())
    got = by_id(suffix_dedup.drop_repeats(documents(spark, list(rows.items()))))
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for i, r in got.items()} == want


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in files.mkString("\n").split("\n") if "/shuffle_" in f}


def test_shuffles_go_when_what_they_were_for_is_stored(spark, odd):
    before, patience = shuffle_files(spark), time.time() + 20
    rows = workspace.stored(odd.repartition(3, "doc_id"), "dealt")
    _, bitmap = jaccard_join.common_hashes(odd, 1000)
    while shuffle_files(spark) - before and time.time() < patience:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert rows.count() == odd.count() and bitmap.any()


def test_texts_under_one_id_lose_only_their_own_bytes(spark, none):
    base, other = prose(70, 40), "nothing of this occurs anywhere else " * 1 + prose(71, 30)
    rows = [(1, base), (5, base), (5, other), (6, other[:80] + prose(72, 20)), (None, base), (5, base)]
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"]) for r in suffix_dedup.drop_repeats(documents(spark, rows)).collect())
    n, m = len(base), len(other)
    assert got == sorted([("1", n, 0), ("5", n, n), ("5", m, 0), ("6", 80 + len(prose(72, 20)), 80), ("None", n, 0), ("5", n, n)])
    assert suffix_dedup.drop_repeats(none).count() == 0


def test_copies_are_shuffled_as_digests_and_first_bodies_once(spark, settings, monkeypatch):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    text, copies, seen, sent, firsts = prose(80, 12_000), 30, shuffle_files(spark), {}, []

    def stored(frame, label):  # as in workspace, but shuffles stay to be measured
        path = workspace.new_directory(spark, label)
        frame.write.parquet(path)
        new = shuffle_files(spark) - seen
        sent[label] = sum(os.path.getsize(f) for f in new if os.path.exists(f))
        seen.update(new)
        kept = spark.read.schema(frame.schema).parquet(path)
        if "body" in frame.columns:
            firsts.append(kept.agg(F.sum(F.octet_length("body"))).first()[0])
            seen.update(shuffle_files(spark))
        return kept

    monkeypatch.setattr(suffix_dedup, "stored", stored)
    left = suffix_dedup.drop_repeats(documents(spark, [(i, text) for i in range(copies)])).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in left) == [(i, len(text) if i else 0) for i in range(copies)]
    assert max(sent.values()) < 3 * copies * len(text)
    assert sum(firsts) < 7 * len(text) and sent["looked-into"] < 1.5 * sum(firsts)


def test_repeat_groups_are_all_equal_windows():
    text = bytes(random.Random(1).choices(range(97, 100), k=200)) * 2
    contents = [text[:90], text[20:140], text[200:300]]
    body, offset, number, least, diverse = suffix_dedup.repeat_groups(contents, np.array([5, 3, 9]))
    found = {}
    for b, o, g in zip(body, offset, number):
        found.setdefault(g, set()).add((int(b), int(o)))
    want = {}
    for b, c in enumerate(contents):
        for o in range(len(c) - 49):
            want.setdefault(c[o : o + 50], set()).add((b, o))
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, want.values()))
    assert all(least[i] == min([5, 3, 9][b] for b, _ in found[number[i]]) for i in range(len(number)))


def without_later_runs(rows, width):
    """Which lines go, by comparing every run with all that begin earlier."""
    texts = sorted({(i, t or "") for i, t in rows if i is not None})
    lines = {x: x[1].split("\n") for x in texts}
    runs, gone = {}, {}
    for x in texts:
        for p in range(len(lines[x]) - width + 1):
            run = tuple(lines[x][p : p + width])
            if any(line.strip(" ") for line in run):
                runs.setdefault(run, []).append((x, p))
    for places in runs.values():
        (x, p), *later = sorted(places)
        for y, q in later:
            if y != x or q - p >= width:
                gone.setdefault(y, set()).update(range(q, q + width))
    out = []
    for i, t in rows:
        every, cut = (t or "").split("\n"), gone.get((i, t or ""), set())
        out.append((i, len(every), len(cut), "\n".join(line for k, line in enumerate(every) if k not in cut)))
    return out


@pytest.mark.parametrize("rounds", [1, 2])
def test_line_runs(spark, odd, none, rounds):
    rng = random.Random(rounds)
    rows = [(i, "\n".join(rng.choices(["a", "b", "c", "", " ", "d" * 9, "é"], k=rng.randint(0, 14)))) for i in range(80)]
    rows += [(100, "x\nx\nx\nx\nx\nx"), (101, "A\nB\nA\nB\nA\nB\nA"), (102, "\n\n\n\n"), (103, None), (None, "a\nb\nc\nd")]
    rows += [rows[3], rows[4], (500, "\n".join(f"line {k % 4000}" for k in range(9000)))]
    got = line_dedup.drop_repeated_runs(documents(spark, rows), rounds).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, without_later_runs(rows, 1 << rounds)))
    # one id over two texts: what the other one repeats is not cut from this one
    two = documents(spark, [(1, "u\nv\nw\nx"), (5, "k\nl\nm\nn\no\np"), (5, "1\n2\nu\nv\nw\nx")])
    assert {r["kept_text"] for r in line_dedup.drop_repeated_runs(two, rounds).collect()} == {"u\nv\nw\nx", "k\nl\nm\nn\no\np", "1\n2"}
    assert line_dedup.drop_repeated_runs(odd).count() == odd.count()
    assert line_dedup.drop_repeated_runs(none).count() == 0


def test_doubling_of_lines_ends_when_names_are_unique(spark):
    copied = [f"line {k}" for k in range(21)]
    rows = documents(spark, [(1, "\n".join(copied)), (2, "\n".join(["own", *copied[3:20], "", "", "end"])), (3, "\n\nend")])
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    got = line_dedup.intervals(rows)
    found = {(r["doc_id"], r["width"], r["at"], r["first"]["doc_id"], r["first"]["at"]) for r in got.collect()}
    want = {(i, w, at + (i == 2) * -2, 1, at) for i in (1, 2) for w in (2, 4, 8, 16) for at in range(3, 21 - w)}
    assert found == want | {(i, 2, at, 2, 19) for i, at in ((2, 19), (3, 1))}
    stretches = {(r["doc_id"], r["start"], r["stop"]) for r in line_dedup.later_stretches(rows).collect()}
    assert stretches == {(2, 1, 18), (3, 1, 3)}


def test_shards_hold_equal_bytes(spark, odd, none):
    rows = [(i, prose(0 if i % 3 == 0 else i, 5 + i % 30)) for i in range(600)]
    frame = documents(spark, rows)
    size = F.octet_length("text") + 1
    dealt = sharding.shard(frame, size, F.xxhash64("text"), F.col("doc_id"), 5)
    assert dealt.columns == [*frame.columns, "shard", "slot"]
    sums, slots = {}, {}
    for r in dealt.collect():
        sums[r["shard"]] = sums.get(r["shard"], 0) + len(r["text"]) + 1
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert max(sums.values()) - min(sums.values()) <= 2 * max(len(t) + 1 for _, t in rows) and len(sums) == 5
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    some = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    assert sharding.shard(odd, some, F.xxhash64("text"), F.col("doc_id"), 3).count() == odd.count()
    assert sharding.shard(none, some, F.xxhash64("text"), F.col("doc_id"), 3).count() == 0


def test_fingerprints(odd, none):
    texts = sorted(((r["doc_id"], r["text"] or "") for r in odd.where("doc_id is not null").dropDuplicates(["doc_id"]).collect()), reverse=True)
    got = by_id(fingerprints.with_next(odd.where("doc_id is not null").dropDuplicates(["doc_id"])))
    for k, (i, text) in enumerate(texts):
        after = texts[(k + 1) % len(texts)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[i]["n_chars"] == len(text)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
    assert got[1]["fingerprint"] == got[2]["fingerprint"] and got[4]["fingerprint"] == got[5]["fingerprint"]
    assert got[2]["near_next"] == 1.0
    assert fingerprints.with_next(odd).count() == odd.count()
    assert fingerprints.with_next(none).count() == 0


def test_one_expression_serves_all_families_of_lexicons(odd):
    plan = fingerprints.with_next(odd)._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 60_000


def test_half_edited_texts_are_nearer_than_others(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = fingerprints.with_next(table).where("n_chars >= 200").collect()
    assert sum(r["near_edited"] > r["near_next"] for r in got) >= 0.9 * len(got) and len(got) > 100
    assert sum(r["near_edited"] > 0 for r in got) >= 0.95 * len(got)


def test_warc_round_trip(spark, tmp_path):
    tricky = "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"
    rows = [(1, "http://a b", "x" * 200_000), (2, None, "é"), (3, "u", "é"), (4, "u", None), (5, "u", ""), (6, "u\r\nX: y", tricky), (None, "u", "é")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload_digest", F.lit(1))
    got = {r["page_id"]: r for r in warc.archive(pages, str(tmp_path / "w")).collect()}
    import base64

    assert len(got) == 7 and all(r["intact"] for r in got.values())
    for page, _, html in rows:
        raw = (html or "").encode()
        assert got[page]["payload_bytes"] == len(raw)
        assert got[page]["payload_digest"] == base64.b32encode(hashlib.sha1(raw).digest()).decode()
    assert (got[3]["record_type"], got[3]["refers_to"]) == ("revisit", 2)
    assert (got[5]["record_type"], got[5]["refers_to"]) == ("revisit", 4)
    assert got[2]["record_type"] == got[6]["record_type"] == got[None]["record_type"] == "response"
    assert warc.archive(pages.limit(0), str(tmp_path / "none")).count() == 0


def test_language(spark, odd, none):
    rows = [(i, " ".join(random.Random(i).choices(["the", "and", "house", "with"] if i % 2 else ["der", "und", "haus", "mit"], k=30)), "en" if i % 2 else "de") for i in range(80)]
    frame = documents(spark, rows)
    model = language_id.learn_from_folds(frame)
    got = by_id(language_id.predict(frame, model))
    assert all(got[i]["lang_pred"] == lang and 0.5 < got[i]["score"] <= 1 for i, _, lang in rows)
    told = by_id(language_id.predict(odd.where("doc_id is not null"), model))
    assert all(told[i]["lang_pred"] == "und" and told[i]["score"] == 0 for i in (4, 5, 6, 11))
    kept = language_id.keep_identified(odd)
    assert kept.columns == odd.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == sorted("1 2 3 7 8 8 9 10 None".split())
    assert language_id.keep_identified(none).count() == 0
    assert {r["lang_pred"] for r in language_id.predict(odd, language_id.learn(none)).collect()} == {"und"}


def test_quality(spark, odd, none):
    rows = [(i, prose(i, 60) + "." if i % 2 else "BUY!!! $$$ " * 40) for i in range(90)]
    frame = documents(spark, rows)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(90)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = by_id(quality.classify(frame, labels))
    assert all(got[i]["predicted"] == i % 2 and 0 <= got[i]["score"] <= 1 for i in range(90))
    assert quality.classify(odd, labels).count() == odd.count()
    assert all(r["score"] == 0.5 for r in quality.classify(odd, labels.limit(0)).collect())
    assert quality.classify(none, labels).count() == 0


def test_scores_match_plain_gaussians(spark):
    """Densities by inverse and determinant instead of cached factors."""
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=(60, 3)), rng.normal(size=(25, 3)) @ np.array([[2, 0.5, 0], [0, 1, 0.3], [0, 0, 0.2]]) + [1, -1, 0.5]])
    label = [0] * 60 + [1] * 25
    features = spark.createDataFrame([(i, list(map(float, r))) for i, r in enumerate(x)] + [(900, [0.0, 1.0, 2.0])], "doc_id long, features array<double>")
    labels = spark.createDataFrame([(i, y) for i, y in enumerate(label)] + [(None, 1), (900, None), (900, 7), (901, 1)], "doc_id long, label int")
    got = by_id(quality.score(features, quality.learn(features, labels, 3)))
    parts = [x[:60], x[60:]]
    pooled = sum(np.cov(p.T, ddof=0) * len(p) for p in parts) / 85
    for i, row in [*enumerate(x), (900, np.array([0.0, 1.0, 2.0]))]:
        logs = []
        for p in parts:
            lean = max(quality.POOLED, 3 / len(p))
            cov = (1 - lean) * np.cov(p.T, ddof=0) + lean * pooled
            cov = (1 - quality.DIAGONAL) * cov + quality.DIAGONAL * np.diag(np.diag(cov)) + quality.LEAST_VARIANCE * np.eye(3)
            away = row - p.mean(axis=0)
            logs.append(np.log((len(p) + 1) / 87) - 0.5 * (np.linalg.slogdet(cov)[1] + away @ np.linalg.inv(cov) @ away))
        assert got[i]["score"] == pytest.approx(1 / (1 + np.exp(logs[0] - logs[1])), abs=1e-9)
        assert got[i]["predicted"] == int(got[i]["score"] >= 0.5)


def test_quality_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    told = quality.classify(docs, labels).join(labels.select("doc_id", "quality"), "doc_id").where("held_out").collect()
    good, bad = ([r["score"] for r in told if r["quality"] == k] for k in (1, 0))
    assert good and bad and np.mean([g > b for g in good for b in bad]) > 0.95


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    told = language_id.predict(docs, language_id.learn_from_folds(docs)).join(docs.select("doc_id", F.col("lang").alias("own")), "doc_id")
    told = told.where(language_id.held_out(F.col("doc_id")) & (F.col("lang_pred") != "und") & F.col("own").isNotNull()).collect()
    assert len(told) > 100 and sum(r["lang_pred"] == r["own"] for r in told) >= 0.95 * len(told)


def test_decontamination(spark, odd, none):
    item = "A train leaves Rome at 9 and covers 120 km in 3 hours . How fast does the train go on its way from Rome ?"
    other = item.replace("Rome", "Milan").replace("120", "240").replace(" 9 ", " 7 ")
    mixed = item.replace("from Rome", "from Oslo")
    merged = item.replace(" 9 ", " 6 ").replace("120", "6").replace(" 3 ", " 6 ")
    short = "What is the capital of France?"
    bench = spark.createDataFrame([(1, item), (2, None), (None, item), (3, "two words"), (4, short), (5, "")], "item_id long, text string")
    rows = [
        (1, prose(1, 20) + ". " + item), (2, other), (3, prose(4, 50)), (4, mixed), (5, None), (6, "Two words"), (6, "Two words"),
        (None, item), (7, merged), (8, prose(5, 9) + " what is the capital of France " + prose(6, 9)), (9, "these are two words"),
        (10, prose(7, 30_000) + ". " + item), (11, "the capital of France"),
    ]
    frame = documents(spark, rows)
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(frame, bench).collect()}
    # neither two towns for one, nor one number for three
    assert got == {(1, 1), (2, 1), (6, 3), (8, 4), (10, 1)}
    kept = decontamination.keep_clean(frame.withColumnsRenamed({"name": "leaking_id", "root": "whole"}), bench)
    assert [r["doc_id"] for r in kept.orderBy("doc_id").collect()] == [None, 3, 4, 5, 7, 9, 11]
    assert decontamination.leaks(none, bench).count() == 0 and decontamination.leaks(frame, bench.limit(0)).count() == 0


def _template(words):
    """The placeholders by the rules as the README states them."""
    number = re.compile(r"[+-]?[0-9][0-9.,:/]*%?")
    out = []
    for i, (raw, o) in enumerate(words):
        before = words[i - 1] if i else ("", "")
        if number.fullmatch(o):
            t = "#number"
        elif i and o.lower() in decontamination.UNITS and number.fullmatch(before[1]):
            t = "#unit"
        elif i and o[0].isupper() and len(o) > 1 and o[1:].isalpha() and o[1:].islower() and before[0][-1] not in ".!?:|":
            t = "#name"
        else:
            t = o.lower()
        out.append((t, o.lower()))
    return out


def _words(text):
    found = [(w, re.sub(r"^[\W_]+|[^\w%]+$|_+$", "", w)) for w in text.split()]
    return _template([(w, o) for w, o in found if o])


@pytest.mark.parametrize("widths", [(8, 12), (5, 6, 7, 8)])
def test_windows_are_found_at_every_distance(spark, widths):
    items = [(w, " ".join(f"item{w}word{k}" for k in range(w))) for w in widths]
    rows = [(100 * w + lead, " ".join(["other"] * lead + [text] + ["after"] * (lead % 3))) for w, text in items for lead in range(10)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.leaks(documents(spark, rows), benchmark).collect()
    assert {(r["doc_id"], r["item_id"], r["share"]) for r in found} == {(i, i // 100, 1.0) for i, _ in rows}
    # runs that no window of the benchmark has keep windows from being looked at
    spots = decontamination._document_windows(decontamination.item_windows(benchmark))
    assert spots.count(f", {decontamination.STEP})") == 1


def test_templates_match_a_plain_search(spark):
    rng = random.Random(9)
    vocabulary = ["Anna", "Rome", "buys", "7", "12", "3.5", "km", "apples", "in", "the", "town", "(of)", "it's", "end.", "Zoë", "5%", "-4", "a1", "Über"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 40))) for _ in range(120)]
    items = [" ".join(rng.choices(vocabulary, k=rng.randint(6, 14))) for _ in range(25)]
    for k in range(60):
        words = items[k % 25].split()
        if k % 3 == 0:
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts[k] += " " + " ".join(words) + " the end"
    want = set()
    for i, text in enumerate(texts):
        doc = _words(text)
        for j, item in enumerate(items):
            own = _words(item)
            width = min(len(own), decontamination.WINDOW)
            windows = {tuple(own[a : a + width]) for a in range(len(own) - width + 1)}
            names = {tuple(t for t, _ in w) for w in windows}
            held = set()
            for shift in range(-len(own), len(doc)):
                found = [
                    a for a in range(len(own) - width + 1)
                    if 0 <= a + shift <= len(doc) - width and [t for t, _ in doc[a + shift : a + shift + width]] == [t for t, _ in own[a : a + width]]
                ]
                slots = {(own[a + d][1], doc[a + shift + d][1]) for a in found for d in range(width) if own[a + d][0][0] == "#"}
                if len(slots) == len({x for x, _ in slots}) == len({y for _, y in slots}):
                    held |= {tuple(t for t, _ in own[a : a + width]) for a in found}
            if len(held) / len(names) >= decontamination.LEAST_SHARE:
                want.add((i, j, len(held), len(names)))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = decontamination.leaks(documents(spark, list(enumerate(texts))), bench).collect()
    assert {(r["doc_id"], r["item_id"], r["n_windows"], r["item_windows"]) for r in got} == want and len(want) > 20


def test_raking_meets_the_marginals(spark, odd, none):
    rows = [(i, prose(i, 10 + i % 7 * 30), ("en", "de")[i % 3 == 0], ("a", "b", "c")[i % 5 % 3]) for i in range(400)]
    table = mixing.cells(documents(spark, rows))
    raked = mixing.rake(table, {d: mixing.targets(table, d) for d in mixing.DIMENSIONS})
    for d in mixing.DIMENSIONS:
        assert all(r["miss"] < 2e-3 for r in mixing.misses(raked, d).collect())
    drawn = mixing.draw(documents(spark, rows))
    assert 0 < drawn.count() < 400 and drawn.count() == mixing.draw(documents(spark, rows)).count()
    assert mixing.draw(odd).where("doc_id = 4").count() == 1
    assert mixing.draw(none).count() == 0
    assert mixing.draw(odd.withColumnsRenamed({"bucket": "of_lang", "name": "whole", "root": "keep"})).count() == mixing.draw(odd).count()


def test_no_cell_gives_more_than_it_has(spark):
    """One language and one topic are so rare that their cells are used up, and others make up for them."""
    cells = [(s, g, t, m) for s, g, t, m in (
        ("a", "en", "short", 500.0), ("a", "de", "short", 30.0), ("a", "en", "table", 20.0), ("b", "en", "short", 300.0),
        ("b", "de", "short", 60.0), ("b", "de", "table", 10.0), ("c", "en", "short", 80.0),
    )]
    table = spark.createDataFrame(cells, "source string, lang string, topic string, mass double")

    def marginal(**shares):
        (name, values), = shares.items()
        return {name: spark.createDataFrame(list(values.items()), f"{name} string, target double")}

    wanted = marginal(source={"a": 0.5, "b": 0.42, "c": 0.08}) | marginal(lang={"en": 0.84, "de": 0.16}) | marginal(topic={"short": 0.95, "table": 0.05})
    raked = mixing.rake(table, wanted, 0.6)
    assert all(r["weight"] <= r["most"] * (1 + 1e-9) for r in raked.collect())
    assert any(r["weight"] >= r["most"] * (1 - 1e-9) for r in raked.collect())
    for d in mixing.DIMENSIONS:
        assert all(r["miss"] <= mixing.TOLERANCE for r in mixing.misses(raked, d).collect())
    keep = {tuple(r)[:3]: r["keep"] for r in mixing.probabilities(raked, 0.6).collect()}
    assert abs(sum(keep[c[:3]] * c[3] for c in cells) - 0.6 * 1000) < 1.5 and max(keep.values()) <= 1
    # more than all there is: the target is lowered and the others share the rest
    far = mixing.rake(table, marginal(topic={"short": 0.5, "table": 0.5}), 0.6)
    got = {r["topic"]: (r["target"], r["weight"]) for r in mixing.misses(far, "topic").collect()}
    assert got["table"] == pytest.approx((0.05, 0.05)) and got["short"] == pytest.approx((0.95, 0.95))


def test_equal_texts_share_a_shard(spark):
    rows = [(i, prose(i // 2, 30 + i // 2 % 20)) for i in range(800)] + [(1000 + i, prose(9999, 30)) for i in range(300)]
    size = F.octet_length("text") + 1
    frame = documents(spark, rows).withColumnsRenamed({"bucket": sharding.GROUP, "name": sharding.AT, "root": "whole"})
    dealt = sharding.shard(frame, size, F.xxhash64("text"), F.col("doc_id"), 8)
    assert dealt.columns == [*frame.columns, "shard", "slot"]
    where, sums = {}, {}
    for r in dealt.collect():
        where.setdefault(r["text"], set()).add(r["shard"])
        sums[r["shard"]] = sums.get(r["shard"], 0) + len(r["text"]) + 1
    assert all(len(shards) == 1 for text, shards in where.items() if text != prose(9999, 30))
    assert len(where[prose(9999, 30)]) > 1  # a quarter of all bytes
    share = sum(sums.values()) / 8
    assert all(abs(x - share) <= share * (sharding.WHOLE + 2 * sharding.TOLERANCE) + 600 for x in sums.values())
