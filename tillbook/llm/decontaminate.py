"""Benchmark decontamination by SimHash windows of item size.

An item of n words is looked for in windows of n words, in a shorter text in the whole text as the one window. A window
and an item are fingerprinted by SimHash over their five-word shingles with counts. Fingerprints of one item size within
`radius` bits are found through BLOCKS wide blocks of bits: two of them agree but for radius / BLOCKS bits on a block, so
none is missed, and an eighth of all pairs is looked at. Every pair is decided by one of two ways: one within the radius
comes from the fingerprints alone, one beyond it (far, but similar all the same) from shingle postings, exactly. A pair whose
window holds fewer than `similarity` of the item's size in places of its shingles cannot be similar and is not compared, any
other is. The weighted Jaccard similarity of the shingle counts decides at `similarity`. Dropping documents ends with
the first similar pair, so postings are searched only where the fingerprints find none.
A window of which fewer than `similarity` of the shingles belong to any item is not
fingerprinted; all others are, at every offset and item size.

Words are runs without white space, compared by their letters and digits in lower case; a word without any
is skipped. Documents stay where they are: items are sent in blocks of at most `block_words` words, one pass
over the documents per block.

Defined cases: items or texts that are null or have no word match nothing; an item without an id has no name to
report in `contamination`, but its passage is dropped like any other; an item of fewer than five words
is one shingle; repeated items and rows are treated alike and separately; of equally similar windows the first counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.simhash import block_bounds
from tillbook.llm.text import CACHED_WORDS, runs

SHINGLE = 5
RADIUS = 20  # at similarity 0.8 without repeated shingles the mean distance is 9.7 bits, standard deviation 2.9
BLOCKS = 3
AT_ONCE = 1 << 20  # pairs of block values compared at a time
FILTER_BITS = 22
STRETCH = 32768


class PlainWords(dict):
    """Hash of the letters and digits of a word in lower case; 0 for a word without any."""

    def __missing__(self, word: bytes) -> int:
        plain = word.decode().lower()
        if not plain.isalnum():
            plain = "".join(filter(str.isalnum, plain))
        value = (xxhash.xxh64_intdigest(plain.encode()) or 1) if plain else 0
        if len(self) < CACHED_WORDS:
            self[word] = value
        return value

    def of(self, text: str | None) -> np.ndarray:
        found = text.encode().split() if text else []
        hashes = np.fromiter(map(self.__getitem__, found), dtype=np.uint64, count=len(found))
        return hashes[hashes != 0]


def window_fingerprints(shingles: np.ndarray, starts: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """SimHash of the shingles of each window; a bit is set if over half the shingles have it."""
    bits = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(shingles) + 1, 64), dtype=np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    over = (sums[starts + widths] - sums[starts]) * 2 > widths[:, None]
    return np.packbits(over, axis=1, bitorder="little").view(np.uint64).reshape(-1)


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of the smaller over the sum of the larger counts of two shingle lists."""
    values, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    x = np.bincount(index[: len(a)], minlength=len(values))
    y = np.bincount(index[len(a) :], minlength=len(values))
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())


class ItemIndex:
    """Items of one shingle size, with a table per block of bits for the Hamming search."""

    def __init__(self, items: list[tuple[int, np.ndarray]], k: int, radius: int):
        self.k, self.radius, self.bounds = k, radius, block_bounds(BLOCKS - 1)
        self.items = [(item, runs(hashes, k)) for item, hashes in items]
        self.widths = np.unique([len(s) for _, s in self.items])
        self.known = np.unique(np.concatenate([s for _, s in self.items]))
        self.mask = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.mask[self.known & np.uint64((1 << FILTER_BITS) - 1)] = True
        self.sizes = own = np.array([len(s) for _, s in self.items])
        self.fps = np.array([window_fingerprints(s, np.zeros(1, np.int64), np.array([len(s)]))[0] for _, s in self.items], dtype=np.uint64)
        self.sized = {w: np.flatnonzero(own == w) for w in self.widths.tolist()}
        # postings: the items of every known shingle
        shingle = np.concatenate([np.unique(s) for _, s in self.items])
        item = np.repeat(np.arange(len(self.items)), [len(np.unique(s)) for _, s in self.items])
        order = np.argsort(shingle, kind="stable")
        self.posted = item[order]
        self.posting_at = np.r_[np.searchsorted(shingle[order], self.known), len(order)]

    def near(self, fps: np.ndarray, widths: np.ndarray) -> np.ndarray:
        """window * items + item of every pair of one width within the radius, in order."""
        most, found = self.radius // BLOCKS, [np.empty(0, dtype=np.int64)]
        for width in np.unique(widths).tolist():
            held, rows = self.sized[width], np.flatnonzero(widths == width)
            step = max(1, AT_ONCE // len(held))
            for at in range(0, len(rows), step):
                mine = rows[at : at + step]
                for first, size in self.bounds:
                    mask = np.uint64((1 << size) - 1)
                    a, b = ((x >> np.uint64(first) & mask).astype(np.uint32) for x in (fps[mine], self.fps[held]))
                    w, i = np.nonzero(np.bitwise_count(a[:, None] ^ b) <= most)
                    close = np.bitwise_count(fps[mine[w]] ^ self.fps[held[i]]) <= self.radius
                    found.append(mine[w[close]] * len(self.items) + held[i[close]])
        return np.unique(np.concatenate(found))

    def occurrences(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items and the places of their shingles in a stretch, by item and place."""
        at = np.minimum(np.searchsorted(self.known, shingles), len(self.known) - 1)
        place = np.flatnonzero(self.known[at] == shingles)
        first, last = self.posting_at[at[place]], self.posting_at[at[place] + 1]
        count = last - first
        offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        item, place = self.posted[np.repeat(first, count) + offset], np.repeat(place, count)
        order = np.lexsort((place, item))
        return item[order], place[order]

    def able(self, held: tuple[np.ndarray, np.ndarray], pairs: np.ndarray, starts: np.ndarray, spans: np.ndarray, similarity: float) -> np.ndarray:
        """Those of the pairs that share enough places to be similar."""
        item, place = held
        w, i = pairs // len(self.items), pairs % len(self.items)
        size = int((starts + spans).max(initial=0)) + 1
        at = item * size + np.minimum(place, size - 1)  # in order, because places are by item
        n = np.searchsorted(at, i * size + starts[w] + spans[w]) - np.searchsorted(at, i * size + starts[w])
        return pairs[n >= similarity * self.sizes[i] - 1e-9]

    def far(
        self, held: tuple[np.ndarray, np.ndarray], fps: np.ndarray, starts: np.ndarray, spans: np.ndarray, sizes: np.ndarray, similarity: float
    ) -> np.ndarray:
        """window * items + item of every pair of one width beyond the radius that shares enough places to be similar, in order."""
        item, place = held
        found = [np.empty(0, dtype=np.int64)]
        cuts = np.flatnonzero(np.r_[True, item[1:] != item[:-1]]) if len(item) else np.empty(0, np.int64)
        by_size = {w: np.flatnonzero(sizes == w) for w in np.unique(sizes).tolist()}
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(item)], strict=True):
            own = int(self.sizes[item[a]])
            if own in by_size and b - a >= similarity * own - 1e-9:
                rows = by_size[own]
                # windows around the item's own places only
                lo, hi = np.searchsorted(starts[rows], [place[a] - own, place[b - 1] + 1])
                rows = rows[lo:hi]
                rows = rows[np.bitwise_count(fps[rows] ^ self.fps[item[a]]) > self.radius]
                n = np.searchsorted(place[a:b], starts[rows] + spans[rows]) - np.searchsorted(place[a:b], starts[rows])
                found.append(rows[n >= similarity * own - 1e-9] * len(self.items) + item[a])
        return np.unique(np.concatenate(found))

    def windows(self, shingles: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
        """Start and item size of the windows that can match: shingles of items make up `similarity` of that size.

        A window ends with the text, so one looked up for a larger item is the whole text.
        """
        likely = np.flatnonzero(self.mask[shingles & np.uint64((1 << FILTER_BITS) - 1)])
        at = np.searchsorted(self.known, shingles[likely])
        likely = likely[self.known[np.minimum(at, len(self.known) - 1)] == shingles[likely]]
        if len(likely) < similarity * self.widths[0] - 1e-9:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        hits = np.zeros(len(shingles) + 1, dtype=np.int32)
        hits[likely + 1] = 1
        np.cumsum(hits, out=hits)
        starts, widths = [], []
        for width in self.widths[similarity * self.widths - 1e-9 <= len(likely)]:
            span = min(int(width), len(shingles))
            found = np.flatnonzero(hits[span:] - hits[:-span] >= similarity * width - 1e-9)
            starts.append(found)
            widths.append(np.full(len(found), width))
        return np.concatenate(starts), np.concatenate(widths)

    def similar(self, hashes: np.ndarray, similarity: float) -> Iterator[tuple[int, float, int, int, int]]:
        """(item, similarity, first word, words, rank) of every similar pair of a text; of a stretch those near in bits come first."""
        shingles = runs(hashes, self.k)
        if not len(shingles):
            return
        starts, sizes = self.windows(shingles, similarity)
        order = np.argsort(starts, kind="stable")
        starts, sizes = starts[order], sizes[order]
        widths = np.minimum(sizes, len(shingles))
        at = 0
        while at < len(starts):  # in stretches, so that memory does not follow the length of the text
            end = min(int(np.searchsorted(starts, starts[at] + STRETCH)), at + STRETCH)
            first, last = starts[at], int((starts[at:end] + widths[at:end]).max())
            begin, span, size = starts[at:end] - first, widths[at:end], sizes[at:end]
            fps = window_fingerprints(shingles[first:last], begin, span)
            held = self.occurrences(shingles[first:last])
            near = self.able(held, self.near(fps, size), begin, span, similarity)
            yield from self.compared(near, at, starts, widths, shingles, similarity)
            far = self.far(held, fps, begin, span, size, similarity)
            yield from self.compared(far, at, starts, widths, shingles, similarity)
            at = end

    def compared(
        self, pairs: np.ndarray, at: int, starts: np.ndarray, widths: np.ndarray, shingles: np.ndarray, similarity: float
    ) -> Iterator[tuple[int, float, int, int, int]]:
        """The similar ones of the pairs of a stretch whose windows count from `at`."""
        for pair in (pairs + at * len(self.items)).tolist():
            w, i = divmod(pair, len(self.items))
            item, own = self.items[i]
            start, width = int(starts[w]), int(widths[w])
            value = weighted_similarity(shingles[start : start + width], own)
            if value >= similarity:
                yield item, value, start, width + self.k - 1, pair

    def matches(self, hashes: np.ndarray, similarity: float) -> dict[int, tuple[float, int, int]]:
        """item -> (similarity, first word, words) of its best window in one text."""
        best: dict[int, tuple] = {}
        for item, value, start, words, rank in self.similar(hashes, similarity):
            if item not in best or (value, -rank) > (best[item][0], -best[item][3]):
                best[item] = (value, start, words, rank)
        return {item: found[:3] for item, found in best.items()}


class Items:
    """Indexes of a block of items; items of fewer than SHINGLE words are one shingle each."""

    def __init__(self, items: list[tuple[int, np.ndarray]], radius: int = RADIUS):
        sized: dict[int, list] = {}
        for item, hashes in items:
            if len(hashes):
                sized.setdefault(min(SHINGLE, len(hashes)), []).append((item, hashes))
        self.indexes = [ItemIndex(held, k, radius) for k, held in sorted(sized.items())]

    def matches(self, hashes: np.ndarray, similarity: float) -> dict[int, tuple[float, int, int]]:
        out: dict[int, tuple[float, int, int]] = {}
        for index in self.indexes:
            for item, found in index.matches(hashes, similarity).items():
                if item not in out or found[0] > out[item][0]:
                    out[item] = found
        return out

    def hold(self, hashes: np.ndarray, similarity: float) -> bool:
        """Whether any item matches; the first similar pair answers."""
        return any(True for index in self.indexes for _ in index.similar(hashes, similarity))


def item_blocks(items: DataFrame, block_words: int) -> Iterator[list[tuple[int | None, str]]]:
    """Items in blocks of at most block_words words; a single longer item is a block of its own."""
    block, size = [], 0
    for item, text in items.select(F.col("item_id").cast("long"), "text").filter("text is not null").toLocalIterator():
        n = len(text.split())
        if block and size + n > block_words:
            yield block
            block, size = [], 0
        block.append((item, text))
        size += n
    if block:
        yield block


def _index(spark, block: list[tuple[int, str]], radius: int):
    plain = PlainWords()
    return spark.sparkContext.broadcast(Items([(i, plain.of(t)) for i, t in block], radius))


def contamination(docs: DataFrame, items: DataFrame, similarity: float = 0.8, radius: int = RADIUS, block_words: int = 500_000) -> DataFrame:
    """doc_id, item_id, similarity, first_word and n_words of the best window, for every match of a row."""
    schema = "doc_id long, item_id long, similarity double, first_word long, n_words long"
    out = docs.sparkSession.createDataFrame([], schema)
    for block in item_blocks(items.filter("item_id is not null"), block_words):
        shared = _index(docs.sparkSession, block, radius)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            plain, index = PlainWords(), shared.value
            for batch in batches:
                found = []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    for item, (value, first, n) in sorted(index.matches(plain.of(text.as_py()), similarity).items()):
                        found.append((doc, item, value, first, n))
                types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
                columns = list(zip(*found, strict=True)) if found else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "item_id", "similarity", "first_word", "n_words"]
                )

        out = out.unionAll(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(search, schema))
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, similarity: float = 0.8, radius: int = RADIUS, block_words: int = 500_000) -> DataFrame:
    """Rows of docs that match no item, every column as it was; no shuffle, ids are not needed."""
    schema, column = docs.schema, docs.columns.index("text")
    for block in item_blocks(items, block_words):
        shared = _index(docs.sparkSession, block, radius)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            plain, index = PlainWords(), shared.value
            for batch in batches:
                keep = [not index.hold(plain.of(t.as_py()), similarity) for t in batch.column(column)]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(clean, schema)
    return docs
