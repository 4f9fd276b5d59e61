"""SimHash fingerprints, links within a Hamming radius by sharded BK-trees, and near-duplicate groups.

Links of fingerprints: two fingerprints that differ in at most `radius` bits agree on one of `radius + 1`
blocks of bits, so a block and its value is a shard that holds all partners. Only distinct fingerprints
travel. A shard gets its BK-tree in the task that owns it. The trees together grow with the corpus and have
no size bound, so they are not broadcast. A shard of more than `shard_rows` fingerprints is cut into parts of
about that size; a task holds the tree of one part and the visitors of one other, for every two parts.

Near-duplicate texts at a Jaccard similarity: 0.8 on word shingles means about ten differing bits, too many
for blocks. There the shards are pairs of minimum shingle hashes (texts at 0.8 share one of the 8 pairs but
for 3 in 10,000), a BK-tree of the shard proposes partners within a wide radius of the SimHash of distinct
shingles, and the shingle sets decide.
Proposed texts already in one group are not compared again, and a shard passes on a spanning forest of its
verified links, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.bktree import BKTree
from tillbook.llm.components import components
from tillbook.llm.text import WordHashes, lower_words, mixed, rows, shingle_set, signed
from tillbook.session import pin

SEED = 42
BANDS, BAND_HASHES = 8, 2
WIDE_RADIUS = 20  # mean distance at similarity 0.8 is 9.7 bits, standard deviation 2.9


def fingerprint(found: list[bytes], k: int) -> int:
    """64-bit SimHash of k-word shingles with repeats; a shorter text is one shingle, no word gives zero."""
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= k:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        digest, ends, at = xxhash.xxh64_intdigest, [], -1
        for word in found:
            at += len(word) + 1
            ends.append(at)
        starts = [0, *(e + 1 for e in ends[: len(ends) - k])]
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[k - 1 :], strict=True)]
    return majority(np.array(hashes, dtype=np.uint64))


def majority(values: np.ndarray) -> int:
    """Bits that more than half of the hashes have; no hash gives zero."""
    total = np.zeros(64, dtype=np.int64)
    for part in range(0, len(values), 65536):
        octets = values[part : part + 65536].view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(total * 2 > len(values), bitorder="little")
    return int.from_bytes(bits.tobytes(), "little")


def fingerprints(docs: DataFrame, k: int = 3) -> DataFrame:
    """doc_id, fp (signed 64 bits) of every row; a null text has no words."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.columns
            found = np.array([fingerprint(lower_words(t.as_py()), k) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([ids, pa.array(signed(found), pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(made, "doc_id long, fp long")


def block_bounds(radius: int) -> list[tuple[int, int]]:
    """First bit and width of radius + 1 blocks that cover the 64 bits."""
    edges = [round(64 * i / (radius + 1)) for i in range(radius + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def in_trees(members: DataFrame, key: list[str], item: str, shard_rows: int) -> DataFrame:
    """Rows of members whose key has several, once per group of their shard: key, tree (the group), own, and their columns.

    A shard of up to shard_rows rows is one part; a larger one is cut by the hash of `item` into parts of about
    that size. A group is two parts: the rows of the first are its tree (own), those of the second visit it, so
    any two parts meet once and no group grows with its shard. A part meets itself in a group of its own.
    """
    counted = members.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    parts = F.ceil(F.col("_n") / shard_rows).cast("long")
    home = F.pmod(F.xxhash64(item), parts)
    return (
        members.join(counted, key)
        .withColumn("_home", home)
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
        .withColumn("tree", F.expr("greatest(_home, _other) * (greatest(_home, _other) + 1) div 2 + least(_home, _other)"))
        .withColumn("own", F.col("_home") >= F.col("_other"))
        .drop("_n", "_home", "_other")
    )


def groups(found: Iterator[tuple], size: int) -> Iterator[list[tuple]]:
    """Neighbouring rows that agree on their first `size` columns."""
    part: list[tuple] = []
    for row in found:
        if part and row[:size] != part[0][:size]:
            yield part
            part = []
        part.append(row)
    if part:
        yield part


def seekers(group: int, own: list[bool]) -> list[int]:
    """Rows that look for partners in the tree of their group: all where a part meets itself, else the visitors."""
    first = (isqrt(8 * group + 1) - 1) // 2
    itself = group - first * (first + 1) // 2 == first
    return [i for i, o in enumerate(own) if itself or not o]


def fingerprint_links(distinct: DataFrame, radius: int, shard_rows: int = 20_000) -> DataFrame:
    """u < v of every two fingerprints in distinct(fp) that differ in 1 to `radius` bits; radius is 1 or more."""
    bounds = block_bounds(radius)
    masks = [((1 << width) - 1) << first for first, width in bounds]
    blocks = F.array(
        *[
            F.struct(F.lit(i).alias("block"), F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1)).alias("value"))
            for i, (first, width) in enumerate(bounds)
        ]
    )
    members = distinct.select("fp", F.explode(blocks).alias("b")).select("b.block", "b.value", "fp")
    visits = in_trees(members, ["block", "value"], "fp", shard_rows).select("block", "value", "tree", "own", "fp")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us, vs = [], []
        for part in groups(rows(batches), 3):
            block = part[0][0]
            tree = BKTree(r[4] & 0xFFFFFFFFFFFFFFFF for r in part if r[3])
            for i in seekers(part[0][2], [r[3] for r in part]):
                fp, inside = part[i][4] & 0xFFFFFFFFFFFFFFFF, part[i][3]
                for other in tree.within(fp, radius):
                    # a pair shows once, as smaller in its own tree or as visitor, and only in the first block it agrees on
                    if (other < fp or not inside) and not any((fp ^ other) & m == 0 for m in masks[:block]):
                        us.append(min(fp, other)), vs.append(max(fp, other))
                if len(us) > 50_000:
                    yield _pairs(us, vs)
                    us, vs = [], []
        yield _pairs(us, vs)

    placed = visits.repartition("block", "value", "tree").sortWithinPartitions("block", "value", "tree")
    return placed.mapInArrow(search, "u long, v long")


def _pairs(us: list[int], vs: list[int]) -> pa.RecordBatch:
    columns = [pa.array(signed(np.array(x, dtype=np.uint64)), pa.int64()) for x in (us, vs)]
    return pa.RecordBatch.from_arrays(columns, ["u", "v"])


def fingerprint_components(docs: DataFrame, k: int = 3, radius: int = 2, shard_rows: int = 20_000) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id, the smallest doc_id reachable over links, for every row.

    Texts without words share the fingerprint zero and are linked like others. A null doc_id never names a
    component unless all its documents lack one. Repeated rows each give a row. Extra columns are not read.
    """
    marked = pin(fingerprints(docs, k), "fingerprints")
    distinct = pin(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    linked = components(fingerprint_links(distinct.select("fp"), radius, shard_rows))
    rooted = distinct.join(linked, distinct["fp"] == linked["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = rooted.join(named, "root").select(F.col("fp").alias("_fp"), "component_id")
    return marked.join(by_fp, marked["fp"] == by_fp["_fp"], "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


# ------------------------------------------------------------------ near-duplicate texts

_rng = np.random.default_rng(20240607)
_XOR = _rng.integers(0, 2**63, BANDS * BAND_HASHES, dtype=np.uint64)
_MUL = _rng.integers(0, 2**63, BANDS * BAND_HASHES, dtype=np.uint64) | np.uint64(1)


def bands(shingles: np.ndarray) -> list[int]:
    """BANDS shard keys, each from BAND_HASHES minimum hashes of a shingle set that is not empty."""
    least = np.array([((shingles ^ x) * m).min() for x, m in zip(_XOR, _MUL, strict=True)], dtype=np.uint64)
    pairs = least.reshape(BANDS, BAND_HASHES)
    return signed(mixed(mixed(pairs[:, 0]) + pairs[:, 1])).tolist()


def _digest(found: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(found))


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, digest of the word sequence, fp of the distinct shingles and bands (null for a text without words)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            ids, texts = batch.columns
            digests, fps, keys = [], [], []
            for t in texts:
                found = lower_words(t.as_py())
                digests.append(_digest(found))
                distinct = shingle_set(found, k, hashes)  # what the Jaccard rule compares; repeats would move bits that it does not see
                fps.append(majority(distinct))
                keys.append(bands(distinct) if found else None)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(digests, pa.binary()), pa.array(signed(np.array(fps, dtype=np.uint64)), pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "digest", "fp", "bands"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(made, "doc_id long, digest binary, fp long, bands array<long>")


def shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    """digest and sorted distinct shingle hashes of every row with words."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                found = [lower_words(t.as_py()) for t in batch.column(0).slice(at, 256)]
                found = [f for f in found if f]
                sets = [signed(shingle_set(f, k, hashes)) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_digest(f) for f in found], pa.binary()), pa.array(sets, pa.list_(pa.int64()))], ["digest", "shingles"]
                )

    return docs.select("text").mapInArrow(made, "digest binary, shingles array<long>")


def _proposed(visits: DataFrame, radius: int) -> DataFrame:
    """Rows of visits(band, key, tree, own, node, fp) with a partner in their tree within the radius."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for part in groups(rows(batches), 3):
            tree: BKTree = BKTree()
            holders: dict[int, list[int]] = {}
            for i, r in enumerate(part):
                if r[3]:
                    fp = r[5] & 0xFFFFFFFFFFFFFFFF
                    tree.add(fp)
                    holders.setdefault(fp, []).append(i)
            active: set[int] = set()
            for i in seekers(part[0][2], [r[3] for r in part]):
                r = part[i]
                near = tree.within(r[5] & 0xFFFFFFFFFFFFFFFF, radius)
                if len(near) > 1 or (near and any(part[j][4] != r[4] for j in holders[near[0]])):
                    active.add(i)
                    if not r[3]:  # a visitor wakes the tree rows it may be close to
                        for n in near:
                            active.update(holders[n])
            out.extend(part[i][:6] for i in active)
            if len(out) > 20_000:
                yield _visit_batch(out)
                out = []
        yield _visit_batch(out)

    placed = visits.repartition("band", "key", "tree").sortWithinPartitions("band", "key", "tree")
    return placed.mapInArrow(search, visits.schema)


def _visit_batch(found: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64()]
    columns = list(zip(*found, strict=True)) if found else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["band", "key", "tree", "own", "node", "fp"])


def shard_links(group: int, own: list[bool], nodes: list, fps: list[int], sets: list[np.ndarray], radius: int, similarity: float) -> list[tuple]:
    """Spanning links of one group: proposed by the BK-tree, verified by exact Jaccard similarity of the sets."""
    mine = [i for i, o in enumerate(own) if o]
    tree = BKTree(fps[i] for i in mine)
    holders: dict[int, list[int]] = {}
    for i in mine:
        holders.setdefault(fps[i], []).append(i)
    sizes = np.array([len(s) for s in sets])
    # postings of the tree's own texts: shingle -> texts that hold it
    flat = np.concatenate([sets[i] for i in mine]) if mine else np.empty(0, dtype=np.int64)
    holder = np.repeat(np.array(mine, dtype=np.int64), sizes[mine]) if mine else np.empty(0, dtype=np.int64)
    order = np.argsort(flat, kind="stable")
    flat, holder = flat[order], holder[order]
    parent = list(range(len(nodes)))

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    found = []
    for i in seekers(group, own):
        near = [j for fp in tree.within(fps[i], radius) for j in holders[fp]]
        near = [j for j in near if j != i and top(j) != top(i) and min(sizes[i], sizes[j]) >= similarity * max(sizes[i], sizes[j])]
        if not near:
            continue
        low, high = np.searchsorted(flat, sets[i], "left"), np.searchsorted(flat, sets[i], "right")
        hit = high > low
        shared = np.zeros(len(nodes), dtype=np.int64)
        for a, b in zip(low[hit], high[hit], strict=True):
            shared[holder[a:b]] += 1
        for j in near:
            both = int(shared[j])
            if both >= similarity * (sizes[i] + sizes[j] - both) - 1e-9 and top(i) != top(j):
                parent[top(i)] = top(j)
                found.append((nodes[i], nodes[j]))
    return found


def near_duplicate_groups(docs: DataFrame, k: int = 5, similarity: float = 0.8, radius: int = WIDE_RADIUS, shard_rows: int = 1000) -> DataFrame:
    """doc_id and keeper, the smallest doc_id of its group, for every row with an id.

    A group holds texts with one word sequence (A-Z in lower case, white space aside; all texts without words
    are one group) and texts linked by a Jaccard similarity of at least `similarity` on k-word shingles.
    """
    known = docs.filter(F.col("doc_id").isNotNull())
    marked = pin(signatures(known, k), "signatures")
    texts = pin(
        marked.groupBy("digest").agg(F.min("doc_id").alias("least"), F.first("fp").alias("fp"), F.first("bands").alias("bands")), "distinct-texts"
    )
    members = texts.select("digest", "fp", F.posexplode("bands").alias("band", "key"))
    visits = in_trees(members.select("band", "key", F.col("digest").alias("node"), "fp"), ["band", "key"], "node", shard_rows)
    proposed = pin(_proposed(visits.select("band", "key", "tree", "own", "node", "fp"), radius), "proposed")

    active = proposed.select("node").distinct()
    wanted = texts.select(F.col("digest").alias("node"), "least").join(active, "node", "left_semi")
    ids = wanted.select(F.col("least").alias("_id")).distinct()
    chosen = known.join(ids, known["doc_id"].cast("long") == ids["_id"], "left_semi")
    sets = shingle_sets(chosen, k).dropDuplicates(["digest"]).select(F.col("digest").alias("node"), "shingles")
    loaded = proposed.join(sets, "node").select("band", "key", "tree", "own", "node", "fp", "shingles")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in groups(_light_rows(batches), 3):
            own, nodes, fps, held = zip(*(r[3:] for r in part), strict=True)
            found = shard_links(part[0][2], list(own), list(nodes), [f & 0xFFFFFFFFFFFFFFFF for f in fps], list(held), radius, similarity)
            if found:
                us, vs = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(us, pa.binary()), pa.array(vs, pa.binary())], ["u", "v"])

    placed = loaded.repartition("band", "key", "tree").sortWithinPartitions("band", "key", "tree")
    linked = components(placed.mapInArrow(verify, "u binary, v binary"))

    rooted = texts.join(linked, texts["digest"] == linked["node"], "left").select("digest", "least", F.coalesce("root", "digest").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("keeper"))
    by_digest = rooted.join(named, "root").select(F.col("digest").alias("_digest"), "keeper")
    return marked.join(by_digest, marked["digest"] == by_digest["_digest"]).select("doc_id", "keeper")


def _light_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows whose last column stays a numpy array."""
    for batch in batches:
        plain = [c.to_pylist() for c in batch.columns[:-1]]
        for i, head in enumerate(zip(*plain, strict=True)):
            yield (*head, batch.columns[-1][i].values.to_numpy(zero_copy_only=False).copy())


def drop_linked(docs: DataFrame, k: int = 3, radius: int = 2, shard_rows: int = 20_000) -> DataFrame:
    """Rows of docs with one document left of each component of fingerprints linked at `radius` bits, every column as it was.

    The smallest doc_id of a component stays. Rows that share an id count as one document: they stay if it is the smallest
    of any of their texts. Rows without an id always stay; texts without words are one component.
    """
    named = fingerprint_components(docs, k, radius, shard_rows)
    return _keepers(docs, named.select("doc_id", F.col("component_id").alias("keeper")))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """Rows of docs with one document left of each near-duplicate group, every column as it was.

    Rows that share an id count as one document: they stay if any of their texts is its group's keeper.
    Rows without an id always stay.
    """
    return _keepers(docs, near_duplicate_groups(docs, **options))


def _keepers(docs: DataFrame, named: DataFrame) -> DataFrame:
    verdict = named.groupBy("doc_id").agg(F.max((F.col("doc_id") == F.col("keeper")).cast("int")).alias("keep"))
    gone = verdict.filter("keep = 0").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, docs["doc_id"].cast("long") == gone["_gone"], "left_anti")
