"""Near duplicates by MinHash, banding, verification and connected components.

1. One pass over the texts gives each its set of five-word shingles, by name, the minima of MINIMA
   universal hash functions over it, and the keys of BANDS bands of ROWS minima. Equal sets are one
   set from here on, so that copies, however many, cost one row each and nothing more.
2. Sets that share a band key meet in a bucket. Each is first held against the bucket's smallest
   member alone: signatures verify, full sets confirm. A bucket of very many near copies is linked
   through that member at a cost in proportion to its rows.
3. Large-star and small-star steps turn these links into components. A bucket of one component is
   settled; in the others, members of different components still have to be compared. Their
   signatures, some 150 bytes each, are compared within the bucket, and those likely enough to link
   form families.
4. The full sets of a family are compared in one task, larger families by pairs of blocks, unless
   already connected. Its links, less than one per set, join those of the second step.

A pair at the threshold is missed with probability (1 - 0.85 ** ROWS) ** BANDS, 2e-8, by the bands
and 1e-9 by the signature, whose cut lies six standard deviations below the threshold. Only full
sets decide what links, so that nothing below the threshold does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.corpus import id_and_text
from orderlens.llm.links import components
from orderlens.llm.word_sets import set_name, shingle_sets
from orderlens.workspace import stored

#: Jaccard threshold in percent.
PERCENT = 85
MINIMA, BANDS, ROWS = 128, 24, 4
#: Share of equal minima (one byte of each is kept) under which a pair is not compared further.
LIKELY = PERCENT / 100 - 6 * (PERCENT / 100 * (1 - PERCENT / 100) / MINIMA) ** 0.5
#: Shingles hashed at a time.
BLOCK = 1 << 14
#: What one task compares: so many signatures, or so many sets and bytes of shingles (a single set may be larger).
MOST_SIGNATURES, MOST_SETS, MOST_BYTES = 8192, 4096, 16 << 20
#: Signatures of small buckets compared in one call, some more or less.
SHELF = 4096

_rng = np.random.default_rng(11)
_A = _rng.integers(0, 1 << 64, MINIMA, dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(0, 1 << 64, MINIMA, dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """Minima of 32-bit universal hashes, (x * a + b) mod 2 ** 64 >> 32, of each set (none empty)."""
    out = np.empty((len(sets), MINIMA), np.uint64)
    at = 0
    while at < len(sets):
        stop, size = at, 0
        while stop < len(sets) and (size == 0 or size + len(sets[stop]) <= BLOCK):
            size += len(sets[stop])
            stop += 1
        x = np.concatenate(sets[at:stop]) >> np.uint64(32)
        starts = np.cumsum([0] + [len(s) for s in sets[at : stop - 1]])
        with np.errstate(over="ignore"):
            for i in range(MINIMA):
                out[at:stop, i] = np.minimum.reduceat(x * _A[i] + _B[i], starts)
        at = stop
    return out >> np.uint64(32)


def band_keys(least: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; bands never share keys but by chance."""
    keys = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None, :], len(least), axis=0)
    with np.errstate(over="ignore"):
        for r in range(ROWS):
            keys = (keys ^ least[:, r : BANDS * ROWS : ROWS]) * _ODD
            keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, len(whole), 1024):
            batch = whole.slice(at, 1024)
            n, names, some = [], [], []
            for hashes in shingle_sets(batch.column("text").cast(pa.binary()).to_pylist()):
                n.append(len(hashes))
                names.append(set_name(hashes))
                if len(hashes):
                    some.append(hashes)
            least = minima(some) if some else np.zeros((0, MINIMA), np.uint64)
            keys, signature = iter(band_keys(least).tolist()), iter(least.astype(np.uint8))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array(n, pa.int64()),
                    pa.array(names, pa.binary()),
                    pa.array([next(keys) if k else None for k in n], pa.list_(pa.int64())),
                    pa.array([next(signature).tobytes() if k else None for k in n], pa.binary()),
                ],
                names=["doc_id", "text_key", "n_shingles", "set_name", "bands", "signature"],
            )


def describe(documents: DataFrame) -> DataFrame:
    """doc_id, text_key, n_shingles, set_name, bands and signature of every row of (doc_id, text)."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.withColumn("text_key", F.xxhash64("text")).mapInArrow(
        _described,
        f"doc_id {kind}, text_key long, n_shingles long, set_name binary, bands array<bigint>, signature binary",
    )


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, len(whole), 256):
            batch = whole.slice(at, 256)
            found = list(shingle_sets(batch.column("text").cast(pa.binary()).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("set_name"), pa.array([h.view(np.int64) for h in found], pa.list_(pa.int64()))],
                names=["set_name", "shingles"],
            )


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree often enough."""
    for batch in batches:
        a, b = (_signatures(batch.column(c).to_pylist()) for c in ("signature_a", "signature_b"))
        near = (a == b).mean(axis=1) >= LIKELY
        yield batch.select(["a", "b"]).filter(pa.array(near))


def _signatures(found: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(found), np.uint8).reshape(len(found), MINIMA)


class _Groups:
    """Union of numbered things."""

    def __init__(self, first: np.ndarray) -> None:
        self.of = first.copy()

    def join(self, a: int, b: int) -> bool:
        x, y = self.of[a], self.of[b]
        if x == y:
            return False
        self.of[self.of == max(x, y)] = min(x, y)
        return True


def _numbered(names: list[bytes]) -> np.ndarray:
    """Equal names as equal numbers: the place of the first of them."""
    first: dict[bytes, int] = {}
    return np.array([first.setdefault(name, k) for k, name in enumerate(names)], np.int64)


def _tied(signature: np.ndarray, n: np.ndarray, component: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which sets, sorted by size, have a likely partner in another component; and their ties between components."""
    ties, tied = _Groups(component), np.zeros(len(n), bool)
    smallest = np.searchsorted(n, -(-PERCENT * n // 100))
    for x in range(1, len(n)):
        other = np.flatnonzero(component[smallest[x] : x] != component[x]) + smallest[x]
        near = other[(signature[other] == signature[x]).mean(axis=1) >= LIKELY] if len(other) else other
        if len(near):
            tied[x] = tied[near] = True
            for y in np.unique(component[near]):
                ties.join(x, int(y))
    return tied, ties.of


def _unsettled(group: pd.DataFrame) -> pd.DataFrame:
    """Sets with a likely partner in their bucket and another component, and the smallest component they are tied to."""
    group = group.sort_values(["band", "n", "set_name"], ignore_index=True).drop_duplicates(["band", "set_name"], ignore_index=True)
    signature, n = _signatures(group["signature"].tolist()), group["n"].to_numpy()
    band, names = group["band"].to_numpy(), group["component"].to_numpy(object)
    begins = np.flatnonzero(np.diff(band, prepend=band[0] - 1 if len(band) else 0))
    out: list[tuple[bytes, bytes, bytes]] = []
    sets = group["set_name"].to_numpy(object)
    for a, b in zip(begins, np.append(begins[1:], len(band))):
        tied, ties = _tied(signature[a:b], n[a:b], _numbered(names[a:b].tolist()))
        least: dict[int, bytes] = {}
        for t, name in zip(ties, names[a:b]):
            least[t] = min(name, least.get(t, name))
        out += [(sets[a + k], names[a + k], least[ties[k]]) for k in np.flatnonzero(tied)]
    return pd.DataFrame(out, columns=["set_name", "component", "tie"])


def confirmed(sets: list[np.ndarray], component: np.ndarray, signature: np.ndarray) -> list[tuple[int, int]]:
    """Links between sets of different components; at most one less than there are sets."""
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    sizes = np.array([len(sets[i]) for i in order], np.int64)
    _, every = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    begins = np.cumsum(sizes) - sizes
    groups, mark, links = _Groups(component[order]), np.zeros(int(every.max()) + 1, bool), []
    signature = signature[order]
    smallest = np.searchsorted(sizes, -(-PERCENT * sizes // 100))
    for x, n in enumerate(sizes):
        y = np.flatnonzero(groups.of[smallest[x] : x] != groups.of[x]) + smallest[x]
        if not len(y):
            continue
        y = y[(signature[y] == signature[x]).mean(axis=1) >= LIKELY]
        own = every[begins[x] : begins[x] + n]
        mark[own] = True
        for k in y:
            if groups.of[k] != groups.of[x]:
                both = int(np.count_nonzero(mark[every[begins[k] : begins[k] + sizes[k]]]))
                if 100 * both >= PERCENT * int(n + sizes[k] - both) and groups.join(x, int(k)):
                    links.append((order[x], order[int(k)]))
        mark[own] = False
    return links


def _confirmed_links(group: pd.DataFrame) -> pd.DataFrame:
    group = group.drop_duplicates("set_name", ignore_index=True)
    names = group["set_name"].tolist()
    sets = [np.asarray(s, np.int64) for s in group["shingles"]]
    links = confirmed(sets, _numbered(group["component"].tolist()), _signatures(group["signature"].tolist()))
    return pd.DataFrame({"a": [names[i] for i, _ in links], "b": [names[j] for _, j in links]})


def _dealt(rows: DataFrame, key: str, blocks: DataFrame) -> DataFrame:
    """Rows of a key with their pair of blocks i <= j; a key of one block stays whole."""
    dealt = rows.join(blocks, key).withColumn("own", F.pmod(F.xxhash64("set_name"), "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    return dealt.drop("own", "other")


def _star_links(stars: DataFrame, reps: DataFrame, full: DataFrame) -> DataFrame:
    """Links (a, b) of bucket members with their bucket's smallest."""
    pairs = stars.select(F.col("set_name").alias("a"), F.col("head").alias("b")).distinct()
    for side in ("a", "b"):
        pairs = pairs.join(
            reps.select(F.col("set_name").alias(side), F.col("signature").alias(f"signature_{side}"), F.col("n").alias(f"n_{side}")),
            side,
        )
    fits = 100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b")
    pairs = pairs.where(fits).select("a", "b", "signature_a", "signature_b").mapInArrow(_likely, "a binary, b binary")
    for side in ("a", "b"):
        pairs = pairs.join(full.select(F.col("set_name").alias(side), F.col("shingles").alias(f"set_{side}")), side)
    both = F.size(F.array_intersect("set_a", "set_b"))
    either = F.size("set_a") + F.size("set_b") - both
    return pairs.where(100 * both >= PERCENT * either).select("a", "b")


def _family_links(members: DataFrame, reps: DataFrame, full: DataFrame, roots: DataFrame) -> DataFrame:
    """Links (a, b) between members of a bucket (band, set_name) that lie in different components."""
    signed = reps.select("set_name", "signature", "n")
    placed = members.join(roots.withColumnRenamed("node", "set_name"), "set_name", "left")
    placed = placed.select("band", "set_name", F.coalesce("root", "set_name").alias("component"))
    open_bands = placed.groupBy("band").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.ceil(F.count("*") / MOST_SIGNATURES).cast("int").alias("blocks"),
    ).where("low <> high").select("band", "blocks")
    left = stored(_dealt(placed, "band", open_bands).join(signed, "set_name"), "minhash-unsettled")
    # most buckets hold a few sets: those of one block are compared by the shelf
    shelves = -(-left.where("blocks = 1").count() // SHELF) or 1
    alone = F.when(F.col("blocks") > 1, F.col("band"))
    shelf = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("band"), F.lit(shelves)))
    ties = stored(
        left.groupBy(alone.alias("alone"), shelf.alias("shelf"), "i", "j")
        .applyInPandas(_unsettled, "set_name binary, component binary, tie binary").distinct(),
        "minhash-ties",
    )
    families = components(ties.select(F.col("component").alias("a"), F.col("tie").alias("b")))
    sets = ties.select("set_name", "component").distinct()
    sets = sets.join(families.withColumnsRenamed({"node": "component", "root": "family"}), "component")
    sets = sets.join(full, "set_name").join(signed.select("set_name", "signature"), "set_name")
    extent = sets.groupBy("family").agg(
        F.greatest(F.ceil(F.count("*") / MOST_SETS), F.ceil(F.sum(8 * F.size("shingles")) / MOST_BYTES)).cast("int").alias("blocks")
    )
    dealt = _dealt(sets, "family", extent)
    return dealt.groupBy("family", "i", "j").applyInPandas(_confirmed_links, "a binary, b binary")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id connected by links) and kept of every row.

    A missing text, and one without words, has no shingles and links with nothing, not even another
    such; a text under five words is one shingle. Rows of equal sets, as repeated rows, are linked,
    also when they share a doc_id. A row without doc_id links as any other but names no component;
    where none of a component has an id, component_id is null. Kept are the rows whose doc_id is
    their component_id, null counting as equal to null. Long texts are shingled in pieces, cut
    between words. An empty table gives an empty result; other columns are ignored.
    """
    documents = id_and_text(documents)
    sets = stored(describe(documents), "minhash-sets")
    reps = stored(
        sets.where("n_shingles > 0").groupBy("set_name").agg(
            F.min("doc_id").alias("first_id"), F.min(F.struct("doc_id", "text_key")).alias("row"),
            F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("signature").alias("signature"),
        ),
        "minhash-reps",
    )
    buckets = reps.select("set_name", F.explode("bands").alias("band"))
    heads = buckets.groupBy("band").agg(F.min("set_name").alias("head"), F.max("set_name").alias("last")).where("head <> last")
    members = stored(buckets.join(heads.drop("last"), "band"), "minhash-buckets")
    stars = members.where("set_name <> head")

    wanted = reps.join(members.select("set_name").distinct(), "set_name").select(
        "set_name", F.col("row.doc_id").alias("of_doc"), F.col("row.text_key").alias("of_key")
    )
    texts = documents.withColumn("text_key", F.xxhash64("text"))
    texts = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["of_doc"]) & (texts["text_key"] == wanted["of_key"]))
    full = stored(
        texts.select("set_name", "text").dropDuplicates(["set_name"]).mapInArrow(_full_sets, "set_name binary, shingles array<bigint>"),
        "minhash-full-sets",
    )

    near = stored(_star_links(stars, reps, full), "minhash-links")
    roots = components(near)
    further = _family_links(members.select("band", "set_name"), reps, full, roots)
    roots = components(near.union(further))

    grouped = reps.join(roots, reps["set_name"] == roots["node"], "left").select(
        "set_name", F.coalesce("root", "set_name").alias("root"), "first_id"
    )
    least = grouped.groupBy("root").agg(F.min("first_id").alias("least_id"))
    membership = grouped.join(least, "root").select("set_name", "least_id")
    component = F.when(F.col("n_shingles") > 0, F.col("least_id")).otherwise(F.col("doc_id"))
    return (
        sets.select("doc_id", "n_shingles", "set_name").join(membership, "set_name", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
