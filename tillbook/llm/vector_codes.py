"""Product codes of vectors: codebooks fitted over the whole table, one byte-sized index for each part of a vector.

Every component x counts as floor(256 * x); a vector is cut into equal consecutive parts, and each part gets the index of
the nearest entry of its position's codebook. A task sorts the distinct parts of a batch, which makes them a lexicographic
trie: all parts that begin with the same components share one vector of distances to the entries, accumulated once. The
trie is walked depth first in blocks of nodes; a leaf takes the least distance and adds its part, times the number of
vectors that have it, to that entry's sum. Tasks send only these sums (parts x entries x components numbers, whatever the
input), so no vector is shuffled and copies of one vector weigh, but do not gather anywhere.

Defined cases: vectors that are null, or hold a null or non-finite component, are dropped, and so are vectors whose length
is not that of the first usable one (by id, then vector; a length that the number of parts divides). Rows without an id
are coded but never begin a codebook; equal ids begin it in the order of their vectors. Fewer rows than entries give
smaller codebooks. Components are held within a bound (2 ** 19 for 64 dimensions) so that errors fit into a long. An empty
table has no codes and empty codebooks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tillbook.operators.scale import broadcast_if_small
from tillbook.session import pin

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256

# Nodes of one depth that are expanded together; what a walk holds is parts' width x BLOCK x entries numbers.
BLOCK = 1024


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    """floor(256 * x), held within the bound under which the distance of two vectors fits into a long."""
    bound = math.isqrt(2**62 // max(1, vectors.shape[1])) // 2
    return np.clip(np.floor(SCALE * vectors.astype(np.float64)), -bound, bound).astype(np.int64)


def usable(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold a usable vector, and their components as whole numbers."""
    fits = pc.fill_null(pc.equal(pc.list_value_length(column), width), False).to_numpy(zero_copy_only=False)
    flat = column.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    finite = np.isfinite(flat).all(axis=1)
    fits[np.flatnonzero(fits)[~finite]] = False
    return fits, whole_numbers(flat[finite])


class Trie:
    """Distinct rows in lexicographic order; the nodes of a depth are the places where a new prefix begins."""

    def __init__(self, parts: np.ndarray):
        order = np.lexsort(parts.T[::-1])
        ordered = parts[order]
        changed = np.ones(ordered.shape, dtype=bool)
        changed[1:] = ordered[1:] != ordered[:-1]
        begins = np.logical_or.accumulate(changed, axis=1)
        leaf = begins[:, -1]
        self.parts = ordered[leaf]
        self.nodes = [np.flatnonzero(column) for column in begins[leaf].T]
        at = np.cumsum(leaf) - 1
        self.counts = np.bincount(at, minlength=len(self.parts))
        self.leaf_of = np.empty(len(parts), dtype=np.int64)
        self.leaf_of[order] = at

    def nearest(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (the lower one of ties) and squared distance, for each leaf."""
        codes = np.zeros(len(self.parts), dtype=np.int64)
        errors = np.zeros(len(self.parts), dtype=np.int64)
        last = len(self.nodes) - 1
        open_ = [(0, lo, min(lo + BLOCK, len(self.nodes[0])), None) for lo in range(0, len(self.nodes[0]), BLOCK)]
        while open_:
            depth, lo, hi, above = open_.pop()
            first = self.nodes[depth][lo:hi]
            sums = (self.parts[first, depth][:, None] - entries[:, depth]) ** 2
            if above is not None:
                parents, shared = above
                sums += shared[np.searchsorted(parents, first, side="right") - 1]
            if depth == last:
                codes[first] = sums.argmin(axis=1)
                errors[first] = sums.min(axis=1)
                continue
            end = self.nodes[depth][hi] if hi < len(self.nodes[depth]) else len(self.parts)
            a, b = np.searchsorted(self.nodes[depth + 1], [first[0], end])
            open_.extend((depth + 1, at, min(at + BLOCK, b), (first, sums)) for at in range(a, b, BLOCK))
        return codes, errors

    def add_to(self, sums: np.ndarray, codes: np.ndarray) -> None:
        """Add every leaf, as often as it occurs, to its entry; the last column counts."""
        np.add.at(sums[:, :-1], codes, self.parts * self.counts[:, None])
        np.add.at(sums[:, -1], codes, self.counts)


def _sums(codebooks: np.ndarray) -> Callable:
    """Sums and counts of the parts nearest to each entry, one set of rows for a task."""
    parts, entries, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width + 1), dtype=np.int64)
        for batch in batches:
            _, found = usable(batch.column(0), parts * width)
            for p in range(parts if len(found) else 0):
                trie = Trie(found[:, p * width : (p + 1) * width])
                trie.add_to(sums[p], trie.nearest(codebooks[p])[0])
        p, e, c = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(c, pa.int32()), pa.array(sums[p, e, c])], ["p", "e", "c", "total"]
        )

    return run


def _encode(codebooks: np.ndarray, names: list[str]) -> Callable:
    parts, _, width = codebooks.shape
    pairs = np.array([f"{i:02x}" for i in range(codebooks.shape[1])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask, found = usable(batch.column(0), parts * width)
            code = np.zeros(len(found), dtype=f"<U{2 * parts}")
            error = np.zeros(len(found), dtype=np.int64)
            for p in range(parts if len(found) else 0):
                trie = Trie(found[:, p * width : (p + 1) * width])
                codes, errors = trie.nearest(codebooks[p])
                code = np.char.add(code, pairs[codes[trie.leaf_of]])
                error += errors[trie.leaf_of]
            rest = [column.filter(pa.array(mask)) for column in batch.columns[1:]]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(code.tolist(), pa.string()), pa.array(error)], [*names, "code", "error"])

    return run


def first_entries(vectors: DataFrame, vec_id: str, vector: str, parts: int, entries: int) -> np.ndarray:
    """Codebooks before the first round: the parts of the rows with the least ids (parts x entries x width)."""
    held = F.col(vector)
    finite = F.forall(held, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = vectors.filter(held.isNotNull() & (F.size(held) > 0) & (F.size(held) % parts == 0) & finite)
    order = [F.col(vec_id).asc(), held.asc()]
    kept = kept.filter(F.col(vec_id).isNotNull()).select(vec_id, vector)
    head = kept.orderBy(*order).limit(1).collect()
    if not head:
        return np.zeros((parts, 0, 1), dtype=np.int64)
    width = len(head[0][1])
    rows = kept.filter(F.size(held) == width).orderBy(*order).limit(entries).collect()
    found = whole_numbers(np.array([r[1] for r in rows], dtype=np.float64))
    return found.reshape(len(rows), parts, width // parts).transpose(1, 0, 2).copy()


def fit(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> np.ndarray:
    """Final codebooks (parts x entries x width); every round reads all vectors and moves each entry to its parts' mean."""
    codebooks = first_entries(vectors, vec_id, vector, parts, entries)
    for _ in range(rounds if codebooks.size else 0):
        found = vectors.select(vector).mapInArrow(_sums(codebooks), "p int, e int, c int, total long")
        sums = np.zeros((*codebooks.shape[:2], codebooks.shape[2] + 1), dtype=object)
        for p, e, c, total in found.groupBy("p", "e", "c").agg(F.sum("total")).collect():
            sums[p, e, c] = total
        used = sums[..., -1] > 0
        codebooks[used] = sums[used][:, :-1] // sums[used][:, -1:]
    return codebooks


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def encode(vectors: DataFrame, codebooks: np.ndarray, keep: list[str], vector: str = "embedding") -> DataFrame:
    """The columns of `keep`, code and error for every usable vector."""
    picked = vectors.select(vector, *keep)
    if not codebooks.size:
        picked = picked.limit(0)
    names = [f"k{i}" for i in range(len(keep))]
    kinds = [StructField(n, f.dataType) for n, f in zip(names, picked.schema.fields[1:], strict=True)]
    out = picked.mapInArrow(_encode(codebooks, names), StructType(kinds).add("code", "string").add("error", "long"))
    return out.toDF(*keep, "code", "error")


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", **shape: int) -> DataFrame:
    """vec_id, label, code, error, label_error and codebooks_sha256 of every usable vector.

    Rows without a label count as one label.
    """
    codebooks = fit(vectors, vec_id, vector, **shape)
    coded = pin(encode(vectors, codebooks, [vec_id, label], vector), "vector-codes")
    totals = coded.groupBy(F.col(label).alias("_label")).agg(F.sum("error").alias("label_error"))
    out = coded.join(broadcast_if_small(totals), F.col(label).eqNullSafe(F.col("_label")))
    return out.drop("_label").withColumn("codebooks_sha256", F.lit(digest(codebooks)))
