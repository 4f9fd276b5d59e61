"""Katz backoff bigram scores: Good-Turing discounts, exactly normalised backoff weights, tables by bucket.

Training counts distinct word pairs per task, ships them as arrays by bucket of the pair's hash and merges each
bucket into one row of the pair table (bucket, w1, w2, n). A text's words are w_1 .. w_m and one end; the first word's
context is the start of the text. With C(h) the tokens after context h,

    P(w | h) = d(c(h, w)) c(h, w) / C(h)           if the pair was seen,
               alpha(h) P(w)                       otherwise,
    P(w)     = d(c(w)) c(w) / N                    if the word was seen, else the mass that the discounts leave,

alpha(h) = left mass of h / (1 - sum of P(w) over words seen after h). Discounts are Katz's for counts up to k = 5, or the
largest k at which all of them lie between 0 and 1; if there is none, 0.5 is taken off every count. A context
whose discounts leave nothing gets one token more in C(h), which is its left mass. So every distribution sums to 1.

A text's log is the backed-off log for every token (word level) plus, for each seen pair, what the pair adds: the
recursion, with the sums grouped by what is looked up. Words above a count that at most `hot_words` words
reach travel as a broadcast table, and so do at most `hot_pairs` pairs; everything rarer is looked up in its
bucket or by a join on the word. Nothing that is shuffled can then have a hot key: a rarer word has at most
N / hot_words of the tokens. Texts are scored in `blocks` parts one after the other, which bounds the disk that
shuffles need at a time.

Defined cases: a null text is empty and consists of its end; a null doc_id trains and is not held out; every row
gives a row, repeated ones too; without training rows every probability is 1 and every log 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.llm.text import mixed, signed
from tillbook.session import new_folder, pin

K = 5
START, END = xxhash.xxh64_intdigest(b"\r"), xxhash.xxh64_intdigest(b"\n")  # no word holds white space
COUNT_TOKENS, SCORE_TOKENS = 1_000_000, 500_000  # tokens that a task holds at a time
SUMMED_PAIRS = 500_000  # gains that a task holds before it sums them by text
BUCKET_BYTES = 4_000_000  # text per bucket
SEEN_BITS = 22
SLICE = 30_000  # entries of an array in a row: larger ones are humongous objects of the JVM, whose heap then grows to its end
BINS = 8  # count bins per power of two
PAIR = np.uint64(0x9E3779B97F4A7C15)
MOST = 2**31 - 1  # a looked-up count that does not fit into 32 bits

PACKED = "bucket int, kind int, a array<long>, b array<long>, n array<int>, doc array<int>, base long"
OUT = "row long, doc_id long, w long, n0 long, na long, nb long, n_tokens long, n_known long, base double, score double"


def held_out():
    """crc32 of the id as text is 1 modulo 5."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))


# ------------------------------------------------------------------ tokens
def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, their contexts, index of their text) as numbers, and the hash of each number; texts end with the end and begin after the start.

    Arrow splits on exactly the white space of bytes.split() and numbers the words, so that only distinct ones are hashed.
    """
    found = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    coded = found.flatten().dictionary_encode()
    plain = coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False)
    end, start = len(plain), len(plain) + 1
    hashes = np.fromiter((*map(xxhash.xxh64_intdigest, plain), END, START), dtype=np.uint64, count=len(plain) + 2)
    w, doc = coded.indices.to_numpy(), np.repeat(np.arange(len(texts)), pc.list_value_length(found).to_numpy())
    # white space at either end of a text leaves an empty word
    full = np.flatnonzero((plain != b"")[w])
    w, doc = w[full], doc[full]
    sizes = np.bincount(doc, minlength=len(texts)) + 1
    words = np.full(len(w) + len(texts), end, dtype=np.int64)
    words[np.arange(len(w)) + doc] = w
    contexts = np.r_[start, words[:-1]]
    contexts[np.cumsum(sizes) - sizes] = start
    return words, contexts[: len(words)], np.repeat(np.arange(len(texts)), sizes), hashes


def counted(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of an ordered array and how often each occurs."""
    at = np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]]) if len(sorted_values) else np.empty(0, np.int64)
    return sorted_values[at], np.diff(np.r_[at, len(sorted_values)])


def distinct_triples(h: np.ndarray, w: np.ndarray, doc: np.ndarray, words: int, texts: int) -> tuple[np.ndarray, ...]:
    """Distinct (h, w, doc) in order and how often each occurs; numbers are below `words` and `texts`."""
    a, b = (words - 1).bit_length(), (texts - 1).bit_length()
    if 2 * a + b < 63:  # the three numbers fit into one, which sorts fastest
        values, n = counted(np.sort(h << (a + b) | w << b | doc))
        return values >> (a + b), values >> b & ((1 << a) - 1), values & ((1 << b) - 1), n
    order = np.lexsort((doc, w, h))
    h, w, doc = h[order], w[order], doc[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (w[1:] != w[:-1]) | (doc[1:] != doc[:-1])] if len(h) else np.empty(0, bool)
    at = np.flatnonzero(new)
    return h[at], w[at], doc[at], np.diff(np.r_[at, len(h)])


def pair_keys(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """A number of the pair; with h it determines w, and its upper bits are mixed well enough for buckets after mixed()."""
    return h * PAIR + w


def bucket_of(h: np.ndarray, w: np.ndarray, buckets: int) -> np.ndarray:
    return ((mixed(pair_keys(h, w)) >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)


def unique_pairs(h: np.ndarray, w: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs and their summed counts, ordered by h and w."""
    order = np.lexsort((w, h))
    h, w = h[order], w[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (w[1:] != w[:-1])] if len(h) else np.empty(0, bool)
    at = np.flatnonzero(new)
    if not len(at):
        return h, w, np.empty(0, np.int64)
    return h[at], w[at], np.add.reduceat(n[order].astype(np.int64), at)


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64()]
    columns = zip(*rows, strict=True) if rows else [[]] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["bucket", "kind", "a", "b", "n", "doc", "base"])


def by_bucket(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """(bucket, columns of its rows) in the order the rows have."""
    if not len(bucket):
        return
    # numbers of 16 bits are sorted by counting
    order = np.argsort(bucket.astype(np.uint16) if bucket.max() < 1 << 16 else bucket, kind="stable")
    bucket = bucket[order]
    columns = [c[order] for c in columns]
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    for a, b in zip(cuts, [*cuts[1:], len(bucket)], strict=True):
        yield (int(bucket[a]), *[c[a:b] for c in columns])


def _arrays(cell, null: int = 0) -> np.ndarray:
    return pc.fill_null(cell.values, null).to_numpy(zero_copy_only=False)


def _chunks(batches: Iterator[pa.RecordBatch], text: int, most: int) -> Iterator[list[pa.Array]]:
    """Columns of rows of about `most` tokens, estimated by length."""
    held, size = [], 0
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy() // 6 + 1)
        at = 0
        while at < batch.num_rows:
            before = int(sizes[at - 1]) if at else 0
            end = min(int(np.searchsorted(sizes, before + most - size)) + 1, batch.num_rows)
            held.append(batch.slice(at, end - at))
            size += int(sizes[end - 1]) - before
            at = end
            if size >= most:
                yield [pa.concat_arrays(c) for c in zip(*(part.columns for part in held), strict=True)]
                held, size = [], 0
    if held:
        yield [pa.concat_arrays(c) for c in zip(*(part.columns for part in held), strict=True)]


# ------------------------------------------------------------------ training
def pair_table(docs: DataFrame, buckets: int) -> DataFrame:
    """bucket, w1, w2, n (arrays ordered by w1, w2): counts of all training pairs, a bucket in rows of SLICE pairs.

    small and binned say how many pairs of the row have count 1 .. K + 1, and lie in each bin of counts.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (texts,) in _chunks(batches, 0, COUNT_TOKENS):
            w, h, _, hashes = tokens(texts)
            pairs, n = counted(np.sort(h << 32 | w))
            h, w = hashes[pairs >> 32], hashes[pairs & 0xFFFFFFFF]
            parts = by_bucket(bucket_of(h, w, buckets), signed(h), signed(w), n)
            yield _packed([(b, 0, x, y, z, [], 0) for b, x, y, z in parts])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None

        def out() -> Iterator[pa.RecordBatch]:
            whole = (np.concatenate(c) for c in zip(*held, strict=True))
            h, w, n = unique_pairs(*(c.view(np.uint64) if i < 2 else c for i, c in enumerate(whole)))
            for first in range(0, len(h), SLICE):
                part = slice(first, first + SLICE)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([at], pa.int32()),
                        pa.array([signed(h[part])], pa.list_(pa.int64())),
                        pa.array([signed(w[part])], pa.list_(pa.int64())),
                        pa.array([n[part]], pa.list_(pa.int64())),
                        pa.array([np.bincount(n[part][n[part] <= K + 1], minlength=K + 2)], pa.list_(pa.int64())),
                        pa.array([np.bincount(np.floor(np.log2(n[part]) * BINS).astype(np.int64))], pa.list_(pa.int64())),
                    ],
                    ["bucket", "w1", "w2", "n", "small", "binned"],
                )

        for batch in batches:
            for i, bucket in enumerate(batch.column("bucket").to_pylist()):
                if bucket != at and held:
                    yield from out()
                    held = []
                at = bucket
                held.append(tuple(_arrays(batch.column(c)[i]).copy() for c in ("a", "b", "n")))
        if held:
            yield from out()

    found = docs.select("text").mapInArrow(count, PACKED)
    placed = found.repartition(_partitions(buckets, 4), "bucket").sortWithinPartitions("bucket")
    return placed.mapInArrow(merge, "bucket int, w1 array<long>, w2 array<long>, n array<long>, small array<long>, binned array<long>")


def _summed(table: DataFrame, column: str) -> list[tuple[int, int]]:
    """Sums of an array column by position."""
    each = table.select(F.posexplode(column).alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n"))
    return sorted((r.at, r.n) for r in each.filter("n > 0").collect())


def _partitions(buckets: int, each: int) -> int:
    """Partitions of about `each` buckets."""
    return max(1, buckets // each)


def discounts(counts: dict[int, int], most: int = K) -> np.ndarray:
    """d(0) .. d(k) of Katz's Good-Turing discounts; empty if no k works, then 0.5 is taken off each count."""
    n = [0] + [counts.get(r, 0) for r in range(1, most + 2)]
    for k in range(most, 0, -1):
        if any(n[r] == 0 for r in range(1, k + 2)):
            continue
        common = (k + 1) * n[k + 1] / n[1]
        if common >= 1:
            continue
        d = np.array([1.0] + [((r + 1) * n[r + 1] / (n[r] * r) - common) / (1 - common) for r in range(1, k + 1)])
        if ((d[1:] > 0) & (d[1:] < 1)).all():
            return d
    return np.empty(0)


def discounted(n, d: np.ndarray):
    """Discounted count of a column of counts."""
    if not len(d):
        return n - 0.5
    out = n.cast("double")
    for r in range(1, len(d)):
        out = F.when(n == r, F.lit(float(d[r]) * r)).otherwise(out)
    return out


def discounted_array(n: np.ndarray, d: np.ndarray) -> np.ndarray:
    if not len(d):
        return n - 0.5
    return np.where(n < len(d), d[np.minimum(n, len(d) - 1)], 1.0) * n


def count_profile(counts: DataFrame) -> tuple[dict[int, int], list[tuple[int, int]]]:
    """How many entries have count 1 .. K + 1, and entries per bin of counts; both of fixed size."""
    small = counts.filter(F.col("n") <= K + 1).groupBy("n").count()
    binned = counts.groupBy(F.floor(F.log2(F.col("n").cast("double")) * BINS).cast("int").alias("bin")).count()
    return {r[0]: r[1] for r in small.collect()}, sorted((r[0], r[1]) for r in binned.collect())


def hot_count(bins: list[tuple[int, int]], most: int) -> int:
    """A count that at most `most` entries reach."""
    total, at = 0, None
    for b, n in sorted(bins, reverse=True):
        total += n
        if total > most:
            break
        at = b
    return int(np.ceil(2 ** (at / BINS) - 1e-9)) if at is not None else 1 << 62


class Model:
    """Tables of a trained model: pairs by bucket, words with c, log P(w), log C and log alpha, and the hot entries."""

    def __init__(self, docs: DataFrame, hot_words: int = 250_000, hot_pairs: int = 400_000):
        size = docs.agg(F.sum(F.length("text") + 1)).first()[0] or 0
        self.buckets = 8 * max(1, int(np.ceil(size / (8 * BUCKET_BYTES))))
        # The one large table that stays for the whole run; zstd takes less disk than the usual codec.
        path, table = new_folder(docs.sparkSession, "katz-pairs"), pair_table(docs, self.buckets)
        table.write.option("compression", "zstd").parquet(path)
        self.pairs = docs.sparkSession.read.schema(table.schema).parquet(path)
        flat = self.pairs.select(F.inline(F.arrays_zip("w1", "w2", "n")))
        counts = pin(flat.groupBy(F.col("w2").alias("w")).agg(F.sum("n").alias("n")), "katz-words")
        self.train_tokens, self.vocabulary = (x or 0 for x in counts.agg(F.sum("n"), F.count(F.lit(1))).first())
        small, bins = count_profile(counts)
        d1 = discounts(small)
        pair_small, pair_bins = dict(_summed(self.pairs, "small")), _summed(self.pairs, "binned")
        self.d2 = discounts(pair_small)
        total = max(1, self.train_tokens)
        if len(d1):
            left = sum((1 - d1[r]) * r * small[r] for r in range(1, len(d1)))
        else:
            left = 0.5 * self.vocabulary
        self.log_unknown = float(np.log10(left / total)) if self.train_tokens else 0.0

        t1 = hot_count(bins, hot_words)
        p = (discounted(F.col("n"), d1) / total).alias("p")
        known = counts.select(F.col("w").alias("w2"), p, F.col("n").alias("c"))
        hot = F.broadcast(known.filter(F.col("c") >= t1).drop("c"))  # at most hot_words rows
        looked = flat.join(hot, "w2", "left")
        rest = looked.filter("p is null").drop("p").join(known.drop("c"), "w2")
        n = F.col("n")
        contexts = (
            looked.filter("p is not null")
            .select("w1", "n", "p")
            .unionAll(rest.select("w1", "n", "p"))
            .groupBy("w1")
            .agg(F.sum("n").alias("tokens"), F.sum(n - discounted(n, self.d2)).alias("taken"), F.sum("p").alias("seen"))
        )
        # what the discounts leave, and one token more where they leave nothing
        extra = F.when(F.col("taken") > 1e-9, F.col("taken")).otherwise(F.lit(1.0))
        c_all = F.when(F.col("taken") > 1e-9, F.col("tokens").cast("double")).otherwise(F.col("tokens") + 1.0)
        unseen = F.greatest(1 - F.col("seen"), F.lit(10.0**self.log_unknown))
        contexts = contexts.select(
            F.col("w1").alias("h"), F.log10(c_all).alias("log_c"), F.log10(extra / c_all / unseen).alias("log_alpha")
        )
        words = counts.join(contexts, counts["w"] == contexts["h"], "full").select(
            F.coalesce("w", "h").alias("w"),
            F.coalesce("n", F.lit(0)).alias("c"),
            F.when(F.col("n").isNotNull(), F.log10(discounted(F.col("n"), d1) / total)).otherwise(self.log_unknown).alias("log_p"),
            F.coalesce("log_c", F.lit(0.0)).alias("log_c"),
            F.coalesce("log_alpha", F.lit(0.0)).alias("log_alpha"),
        )
        self.words = pin(words, "katz-weights")
        always = F.col("w").isin(int(signed(np.array([START], np.uint64))[0]), int(signed(np.array([END], np.uint64))[0]))
        table = columns_of(self.words.filter((F.col("c") >= t1) | always))  # at most hot_words + 2 rows
        order = np.argsort(table["w"].view(np.uint64))
        self.hot = {c: v[order] for c, v in table.items()}
        self.hot["w"] = self.hot["w"].view(np.uint64)
        # a hot pair consists of hot words, because a word is at least as frequent as its pairs
        t2 = max(hot_count(pair_bins, hot_pairs), t1)
        found = columns_of(flat.filter(F.col("n") >= t2))  # at most hot_pairs rows
        i, j = self.index(found["w1"].view(np.uint64)), self.index(found["w2"].view(np.uint64))
        key = i * len(self.hot["w"]) + j
        order = np.argsort(key)
        gain = np.log10(discounted_array(found["n"], self.d2)) - self.hot["log_c"][i] - self.hot["log_alpha"][i] - self.hot["log_p"][j]
        self.hot_pair, self.hot_gain = key[order], gain[order]

    def index(self, w: np.ndarray) -> np.ndarray:
        return hot_index(self.hot["w"], w)

    def shared(self) -> dict:
        """What tasks need: hot entries and a few numbers."""
        base = np.log10((self.hot["c"] + 0.5) / (self.train_tokens + 0.5 * (self.vocabulary + 1)))
        seen = np.zeros(1 << SEEN_BITS, dtype=bool)
        seen[_slot(self.hot_pair)] = True
        return {
            "hot": self.hot | {"base": base},
            "pair": self.hot_pair,
            "gain": self.hot_gain,
            "seen": seen,
            "d2": self.d2,
            "buckets": self.buckets,
        }


def columns_of(df: DataFrame) -> dict[str, np.ndarray]:
    """Columns of a small table on the driver."""
    found = df.toArrow()
    return {c: np.array(found.column(c).to_numpy(), copy=True) for c in found.column_names}


def hot_index(table: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Position of each word in a sorted table, -1 without one."""
    if not len(table):
        return np.full(len(w), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(table, w), len(table) - 1)
    return np.where(table[at] == w, at, -1)


# ------------------------------------------------------------------ scoring
def _out(row, doc_id=None, w=None, n0=None, na=None, nb=None, n_tokens=None, n_known=None, base=None, score=None) -> pa.RecordBatch:
    size, names = len(row), [c.split()[0] for c in OUT.split(", ")]
    values = [row, doc_id, w, n0, na, nb, n_tokens, n_known, base, score]
    columns = []
    for name, v in zip(names, values, strict=True):
        kind = pa.float64() if name in ("base", "score") else pa.int64()
        columns.append(pa.nulls(size, kind) if v is None else pa.array(v, kind))
    return pa.RecordBatch.from_arrays(columns, names)


def _slot(key: np.ndarray) -> np.ndarray:
    """Place of a pair of hot words in the table that says which pairs may be hot."""
    return (key.astype(np.uint64) * PAIR) >> np.uint64(64 - SEEN_BITS)


def chunk_rows(rows: pa.Array, doc_ids: pa.Array, texts: pa.Array, shared: dict) -> list[tuple]:
    """PACKED rows of a chunk of texts: pairs to look up by bucket, rare words of its texts, and sums over hot words and pairs.

    A text is named by the distance of its row number from the first one's.
    """
    hot, buckets = shared["hot"], shared["buckets"]
    row = rows.to_numpy()
    base, place = int(row[0]), (row - row[0]).astype(np.int32)
    w, h, doc, hashes = tokens(texts)
    size, words, start = len(row), len(hashes), len(hashes) - 1
    n_tokens = np.bincount(doc, minlength=size)

    # sums over hot words; a word is also the context of the next, the end has 0 there and every text has the start
    at = hot_index(hot["w"], hashes)
    is_hot = at >= 0
    of_word = np.where(is_hot, hot["log_p"][at] + hot["log_alpha"][at], 0.0) if len(hot["w"]) else np.zeros(len(at))
    of_base = np.where(is_hot, hot["base"][at], 0.0) if len(hot["w"]) else np.zeros(len(at))
    is_known = is_hot & (hot["c"][at] > 0) if len(hot["w"]) else is_hot
    score = np.bincount(doc, weights=of_word[w], minlength=size)
    score += hot["log_alpha"][at[start]] if at[start] >= 0 else 0.0
    bases = np.bincount(doc, weights=of_base[w], minlength=size)
    n_known = np.bincount(doc[is_known[w]], minlength=size)

    rare = ~is_hot[w]
    _, rare_word, rare_doc, n0 = distinct_triples(np.zeros(int(rare.sum()), np.int64), w[rare], doc[rare], words, size)

    h, w, doc, n = distinct_triples(h, w, doc, words, size)
    i, j = at[h], at[w]
    both = (i >= 0) & (j >= 0)
    key = i * len(hot["w"]) + j
    found = np.flatnonzero(both & shared["seen"][_slot(key)])
    where = hot_index(shared["pair"], key[found])
    found, where = found[where >= 0], where[where >= 0]
    score += np.bincount(doc[found], weights=shared["gain"][where] * n[found], minlength=size)
    open_ = both.copy()
    open_[found] = False

    packed = []
    for kind, chosen, a, b in ((1, open_, i, j), (2, ~both, signed(hashes)[h], signed(hashes)[w])):
        c = np.flatnonzero(chosen)
        place_of = bucket_of(hashes[h[c]], hashes[w[c]], buckets)
        packed += [(bk, kind, *cols, base) for bk, *cols in by_bucket(place_of, a[c], b[c], n[c], place[doc[c]])]

    def anywhere(kind: int) -> int:
        return int(mixed(np.array([base + kind], dtype=np.int64))[0] >> np.uint64(33)) % buckets

    none = np.empty(0, np.int64)
    rare_hash, rare_place = signed(hashes[rare_word]), place[rare_doc]
    for first in range(0, len(n0), SLICE):
        part = slice(first, first + SLICE)
        packed.append((anywhere(3), 3, rare_hash[part], none, n0[part], rare_place[part], base))
    packed.append((anywhere(4), 4, score.view(np.int64), bases.view(np.int64), n_tokens, place, base))
    ids = pc.fill_null(doc_ids, 0).to_numpy()
    missing = pc.is_null(doc_ids).to_numpy(zero_copy_only=False).astype(np.int64)
    packed.append((anywhere(5), 5, ids, missing, n_known, place, base))
    return packed


def lookup_table(slices: list[tuple]) -> tuple:
    """Pairs of a bucket and their order by key."""
    h, w, n = (np.concatenate(c) for c in zip(*slices, strict=True))
    h, w = h.view(np.uint64), w.view(np.uint64)
    keys = pair_keys(h, w)
    order = np.argsort(keys)
    return h, w, n, keys[order], order


def bucket_rows(model: tuple, kind: int, a: np.ndarray, b: np.ndarray, n: np.ndarray, doc: np.ndarray, shared: dict):
    """Of pairs of one chunk in one bucket: (text, gain), and rare words of seen pairs as (text, word, as context, as word)."""
    hot = shared["hot"]
    h, w, count, keys, order = model
    if kind == 1:
        i, j, a, b = a, b, hot["w"][a], hot["w"][b]
    else:
        a, b = a.view(np.uint64), b.view(np.uint64)
    key = pair_keys(a, b)
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    found = np.flatnonzero(keys[at] == key)
    at = order[at[found]]
    found, at = found[h[at] == a[found]], at[h[at] == a[found]]  # with the context, the key determines the word
    if kind == 1:
        i, j = i[found], j[found]
    else:
        i, j = hot_index(hot["w"], a[found]), hot_index(hot["w"], b[found])
    doc, n = doc[found], n[found]
    gain = np.log10(discounted_array(count[at], shared["d2"]))
    gain -= np.where(i >= 0, hot["log_c"][i] + hot["log_alpha"][i], 0.0)
    gain -= np.where(j >= 0, hot["log_p"][j], 0.0)
    lost_i, lost_j = i < 0, j < 0
    rare = (
        np.r_[doc[lost_i], doc[lost_j]],
        np.r_[signed(h)[at[lost_i]], signed(w)[at[lost_j]]],
        np.r_[n[lost_i], np.zeros(lost_j.sum(), np.int64)],
        np.r_[np.zeros(lost_i.sum(), np.int64), n[lost_j]],
    )
    return (doc, gain * n), rare


def score_block(rows: DataFrame, model: Model) -> DataFrame:
    """OUT rows of rows(row, doc_id, text): sums per text, and rare words still to be joined."""
    shared = rows.sparkSession.sparkContext.broadcast(model.shared())
    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _chunks(batches, 2, SCORE_TOKENS):
            packed = chunk_rows(*columns, shared.value)
            for at in range(0, len(packed), 64):
                yield _packed(packed[at : at + 64])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, at, slices = None, None, []
        texts, gains, size = [], [], 0
        lost, lost_size = [], 0  # many small results become few batches

        def rare_rows() -> pa.RecordBatch:
            row, word, na, nb = (np.concatenate(c) for c in zip(*lost, strict=True))
            return _out(row, w=word, na=na, nb=nb)

        def summed() -> pa.RecordBatch:
            ids, index = np.unique(np.concatenate(texts), return_inverse=True)
            return _out(ids, score=np.bincount(index, weights=np.concatenate(gains)))

        for batch in batches:
            for k in range(batch.num_rows):
                bucket, kind, base = (batch.column(c)[k].as_py() for c in ("bucket", "kind", "base"))
                a, b, n = (_arrays(batch.column(c)[k], MOST) for c in "abn")
                if kind == 0:
                    slices = slices if at == bucket else []
                    slices.append((a.copy(), b.copy(), n.copy()))
                    tables, at = None, bucket
                    continue
                if kind >= 3:
                    row = _arrays(batch.column("doc")[k]).astype(np.int64) + base
                    if kind == 3:
                        yield _out(row, w=a, n0=n)
                    elif kind == 4:
                        yield _out(row, n_tokens=n, base=b.view(np.float64), score=a.view(np.float64))
                    else:
                        yield _out(row, doc_id=pa.array(a, mask=b.astype(bool)), n_known=n)
                    continue
                if at != bucket:  # no training pair fell into this bucket
                    continue
                if tables is None:
                    tables, slices = lookup_table(slices), []
                (text, gain), (doc, word, na, nb) = bucket_rows(tables, kind, a, b, n, _arrays(batch.column("doc")[k]), shared.value)
                texts.append(text.astype(np.int64) + base), gains.append(gain)
                size += len(text)
                if size > SUMMED_PAIRS:
                    yield summed()
                    texts, gains, size = [], [], 0
                if len(doc):
                    lost.append((doc.astype(np.int64) + base, word, na, nb))
                    lost_size += len(doc)
                    if lost_size > 200_000:
                        yield rare_rows()
                        lost, lost_size = [], 0
        if size:
            yield summed()
        if lost:
            yield rare_rows()

    texts = rows.mapInArrow(chunk, PACKED)
    # A count beyond 2 ** 31 becomes null; it is that of a hot pair, which is never looked up here.
    pairs = model.pairs.selectExpr("bucket", "0 kind", "w1 a", "w2 b", "try_cast(n as array<int>) n", "cast(null as array<int>) doc", "0L base")
    placed = texts.unionByName(pairs).repartition(_partitions(model.buckets, 4), "bucket").sortWithinPartitions("bucket", "kind")
    return placed.mapInArrow(answer, OUT)


# Shuffle files go when their job's result is written, not when the driver happens to collect garbage, and rows of
# large arrays are handed to Python in small batches.
SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


@contextmanager
def settings(spark: SparkSession) -> Iterator[None]:
    """SETTINGS while the jobs of an operator run; the session gets its own back."""
    before = {k: spark.conf.get(k) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def scores(docs: DataFrame, hot_words: int = 250_000, hot_pairs: int = 400_000, blocks: int = 3) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of docs(doc_id, text)."""
    with settings(docs.sparkSession):
        return _scores(docs, hot_words, hot_pairs, blocks)


def _scores(docs: DataFrame, hot_words: int, hot_pairs: int, blocks: int) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = Model(rows.filter(~held_out()), hot_words, hot_pairs)
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    total = float(model.train_tokens + 0.5 * (model.vocabulary + 1))
    words = model.words.select(F.col("w").alias("_w"), "c", "log_p", "log_c", "log_alpha")
    out = None
    for block in range(blocks):
        part = numbered.filter(F.pmod(F.xxhash64("doc_id"), F.lit(blocks)) == block)
        # Rows with a rare word meet it, the others go by their text's number and meet nothing; every figure is linear.
        # What a text has once travels as one struct, which the many rows of rare words leave empty.
        rare, once = F.col("w").isNotNull(), ("doc_id", "n_tokens", "n_known", "base", "score")
        found = score_block(part, model).select(
            "row", rare.alias("rare"), F.coalesce("w", "row").alias("key"), "n0", "na", "nb", F.when(~rare, F.struct(*once)).alias("once")
        )
        joined = found.join(words, (found["key"] == words["_w"]) & found["rare"], "left")
        n0, na, nb = (F.coalesce(c, F.lit(0)) for c in ("n0", "na", "nb"))
        c, log_p = F.coalesce("c", F.lit(0)), F.coalesce("log_p", F.lit(model.log_unknown))
        log_alpha, log_c = F.coalesce("log_alpha", F.lit(0.0)), F.coalesce("log_c", F.lit(0.0))
        of_rare = {
            "n_known": F.when(c > 0, n0).otherwise(0),
            "base": n0 * F.log10((c + 0.5) / F.lit(total)),
            "score": n0 * (log_p + log_alpha) - na * (log_c + log_alpha) - nb * log_p,
        }
        answered = joined.select(
            "row", "once.doc_id", "once.n_tokens", *[F.when(F.col("rare"), v).otherwise(F.col(f"once.{k}")).alias(k) for k, v in of_rare.items()]
        )
        summed = answered.groupBy("row").agg(
            F.max("doc_id").alias("doc_id"), *[F.sum(x).alias(x) for x in ("n_tokens", "n_known", "base", "score")]
        )
        summed = pin(summed, "katz-scores")
        out = summed if out is None else out.unionAll(summed)
    return out.select(
        "doc_id",
        held_out().alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
    )
