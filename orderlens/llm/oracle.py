"""The corpus queries that SQL can state, as SQL over the test tables."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def jaccard_components(percent: int, kept: bool) -> str:
    """Links between all pairs of five-word shingle sets, and the smallest id each document reaches."""
    return rf"""
WITH RECURSIVE split AS (
    SELECT doc_id, REGEXP_EXTRACT_ALL(TRANSLATE(COALESCE(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS words
    FROM documents),
shingled AS (
    SELECT DISTINCT doc_id, UNNEST(LIST_TRANSFORM(GENERATE_SERIES(1, GREATEST(1, LEN(words) - 4)),
           lambda i: ARRAY_TO_STRING(words[i : i + 4], ' '))) AS shingle
    FROM split WHERE LEN(words) > 0),
sizes AS (SELECT doc_id, COUNT(*) AS n FROM shingled GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS shared
    FROM shingled a JOIN shingled b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared >= {percent} * (x.n + y.n - shared)),
reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.other)
SELECT doc_id, COALESCE(ANY_VALUE(n), 0) AS n_shingles, MIN(other) AS component_id
       {", doc_id = MIN(other) AS kept" if kept else ""}
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id"""


def _whole(scale: int) -> str:
    return f"""
kept AS (
    SELECT vec_id, label, LIST_TRANSFORM(embedding, lambda x: FLOOR(CAST(x AS DOUBLE) * {scale})) AS v FROM embeddings
    WHERE LEN(embedding) = 64 AND LEN(LIST_FILTER(embedding, lambda x: x IS NULL OR NOT ISFINITE(x))) = 0)"""


# Whole numbers far below 2 ** 53: inner products of doubles are exact.
_FAR = "CAST(LIST_INNER_PRODUCT({a}, {a}) - 2 * LIST_INNER_PRODUCT({a}, {b}) + LIST_INNER_PRODUCT({b}, {b}) AS BIGINT)"


def dictionary_codes(entries: int = 256, rounds: int = 4) -> str:
    def near(k: int) -> str:
        far = _FAR.format(a="piece", b="entry_v")
        return f"""
near{k} AS MATERIALIZED (
    SELECT vec_id, part, MIN({far} * 1000 + entry) AS found FROM pieces JOIN book{k} USING (part) GROUP BY ALL)"""

    def book(k: int) -> str:
        return f"""
mean{k} AS (
    SELECT part, found % 1000 AS entry, i, FLOOR(SUM(piece[i]) / COUNT(*)) AS x
    FROM near{k - 1} JOIN pieces USING (vec_id, part), (SELECT UNNEST(GENERATE_SERIES(1, 16)) AS i) GROUP BY ALL),
moved{k} AS (SELECT part, entry, LIST(x ORDER BY i) AS v FROM mean{k} GROUP BY ALL),
book{k} AS MATERIALIZED (
    SELECT part, entry, COALESCE(v, entry_v) AS entry_v FROM book{k - 1} LEFT JOIN moved{k} USING (part, entry))"""

    steps = ",".join(x for k in range(rounds + 1) for x in ([book(k)] if k else []) + [near(k)])
    return f"""
WITH {_whole(1024)},
pieces AS MATERIALIZED (
    SELECT vec_id, part, v[16 * part + 1 : 16 * part + 16] AS piece
    FROM kept, (SELECT UNNEST(GENERATE_SERIES(0, 3)) AS part)),
book0 AS (
    SELECT part, ROW_NUMBER() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, piece AS entry_v
    FROM pieces QUALIFY entry < {entries}),{steps},
coded AS (
    SELECT vec_id, STRING_AGG(PRINTF('%02x', found % 1000), '' ORDER BY part) AS code,
           CAST(SUM(found // 1000) AS BIGINT) AS error
    FROM near{rounds} GROUP BY vec_id),
labelled AS (SELECT vec_id, label, code, error FROM coded JOIN kept USING (vec_id)),
by_label AS (SELECT label, CAST(SUM(error) AS BIGINT) AS label_error FROM labelled GROUP BY label),
books AS (
    SELECT SHA256(STRING_AGG(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, i)) AS codebooks_sha256
    FROM (SELECT part, entry, UNNEST(entry_v) AS x, GENERATE_SUBSCRIPTS(entry_v, 1) AS i FROM book{rounds}))
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM labelled JOIN by_label ON labelled.label IS NOT DISTINCT FROM by_label.label CROSS JOIN books"""


def centroid_clusters(centroids: int = 40, rounds: int = 5, seed: int = 2) -> str:
    def near(k: int) -> str:
        return f"""
near{k} AS MATERIALIZED (
    SELECT vec_id, MIN({_FAR.format(a="v", b="c")} * 1000 + number) AS found FROM kept CROSS JOIN centers{k} GROUP BY ALL)"""

    def centers(k: int) -> str:
        return f"""
mean{k} AS (
    SELECT found % 1000 AS number, i, FLOOR(SUM(v[i]) / COUNT(*)) AS x
    FROM near{k - 1} JOIN kept USING (vec_id), (SELECT UNNEST(GENERATE_SERIES(1, 64)) AS i) GROUP BY ALL),
moved{k} AS (SELECT number, LIST(x ORDER BY i) AS m FROM mean{k} GROUP BY ALL),
centers{k} AS MATERIALIZED (
    SELECT number, COALESCE(m, c) AS c FROM centers{k - 1} LEFT JOIN moved{k} USING (number))"""

    steps = ",".join(x for k in range(rounds + 1) for x in ([centers(k)] if k else []) + [near(k)])
    return f"""
WITH {_whole(256)},
centers0 AS (
    SELECT ROW_NUMBER() OVER (ORDER BY SHA256('{seed}:' || vec_id)) - 1 AS number, v AS c
    FROM kept QUALIFY number < {centroids}),{steps},
told AS (SELECT vec_id, found % 1000 AS number, found // 1000 AS distance FROM near{rounds}),
facts AS (
    SELECT number, CAST(SUM(distance) AS BIGINT) AS cluster_inertia, CAST(SUM(SUM(distance)) OVER () AS BIGINT) AS inertia
    FROM told GROUP BY number)
SELECT vec_id, CAST(number AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance, cluster_inertia, inertia,
       SHA256(ARRAY_TO_STRING(LIST_TRANSFORM(c, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM told JOIN facts USING (number) JOIN centers{rounds} USING (number)"""


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

#: Forty bits are ten hex digits and eight letters.
_DIGEST = f"""ARRAY_TO_STRING(LIST_TRANSFORM(GENERATE_SERIES(0, 31), lambda k: '{_BASE32}'[1 + CAST(
    (CAST('0x' || SHA1(html)[1 + 10 * (k // 8) : 10 + 10 * (k // 8)] AS BIGINT) >> (35 - 5 * (k % 8))) & 31 AS INTEGER)]), '')"""

WARC_REVISITS = f"""
WITH payloads AS (
    SELECT page_id, STRLEN(html) AS payload_bytes, {_DIGEST} AS payload_digest, MIN(page_id) OVER (PARTITION BY html) AS first_id
    FROM (SELECT page_id, COALESCE(html, '') AS html FROM pages))
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to{{more}}
FROM payloads"""
