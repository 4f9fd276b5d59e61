"""Quality rules judged by an isolation forest.

Rule statistics come from whole texts in one pass and are written once. Each isolation tree is grown on a
few hundred documents (that sampling is the method's own) from a pool of `trees * tree_rows` documents
picked by the hash of their id. Every document is scored; short average paths over the random splits mark
anomalies. The score above which a document goes is calibrated on every labelled row that the base rules pass: the histogram of
scores by label has a fixed number of bins, so only that reaches the driver.

Defined cases: a null or empty text has no words and fails the base rules; a null id is allowed; repeated
rows each give a row; without documents there is no forest and no row; without labelled rows (or with one
kind of label only) the forest rejects nothing and the base rules decide alone; ties in the hash order are
broken by the id, equal scores share a bin and so one verdict. Extra columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tillbook.llm.text import SPACES, WordHashes, runs
from tillbook.session import pin

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEAT_PERCENT = 30

# Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_adjacent"]


def repeated_words(hashes: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows of `window` words that occur at least twice in the text."""
    if len(hashes) <= window:
        return 0
    found = runs(hashes, window)
    _, index, count = np.unique(found, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(count[index] > 1)
    if not len(starts):
        return 0
    edges = np.zeros(len(hashes) + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def capitals(text: str) -> int:
    """Letters A-Z and their accented kin in the Latin-1 range."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    return int((((points >= 0x41) & (points <= 0x5A)) | ((points >= 0xC0) & (points <= 0xDE) & (points != 0xD7))).sum())


def text_counts(text: str | None, hashes: WordHashes) -> tuple[int, ...]:
    """COUNTS of one text."""
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode()
    found = raw.split()
    if not found:
        return (0, 0, len(raw) - len(raw.translate(None, SYMBOLS)), 0, 0, 0, 0, 0)
    ids = hashes.array(found)
    lines = [line for line in raw.split(b"\n") if line.strip(SPACES)]
    return (
        len(found),
        len(text) - (len(raw) - len(raw.translate(None, SPACES))),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(ids),
        len(lines),
        capitals(text),
        int((ids[1:] == ids[:-1]).sum()),
    )


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        ids, texts = batch.columns
        counted = [text_counts(t.as_py(), hashes) for t in texts]
        columns = [pa.array(c, pa.int64()) for c in zip(*counted, strict=True)] if counted else [pa.array([], pa.int64())] * len(COUNTS)
        yield pa.RecordBatch.from_arrays([ids, *columns], ["doc_id", *COUNTS])


def rule_counts(docs: DataFrame) -> DataFrame:
    """doc_id and COUNTS of every row."""
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_count_rows, schema)


def rule_statistics(counts: dict[str, np.ndarray]) -> np.ndarray:
    """One column per rule, zero where the rule has nothing to say, larger the more it is broken."""
    n = np.maximum(counts["n_words"], 1)
    chars = np.maximum(counts["word_chars"], 1)
    lines = np.maximum(counts["n_lines"], 1)
    length = counts["word_chars"] / n
    return np.column_stack(
        [
            counts["n_symbols"] / chars,
            np.maximum(0, counts["n_dup_lines"] / lines - 0.25),
            np.maximum(0, counts["n_repeat_words"] / n - 0.15),
            np.maximum(0, counts["n_upper"] / chars - 0.1),
            np.maximum(0, counts["n_adjacent"] / n - 0.02),
            np.maximum(0, np.abs(np.log(np.maximum(length, 0.1) / 5)) - 0.4),
        ]
    )


def average_path(n: float) -> float:
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def grow_tree(sample: np.ndarray, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """Random splits until a row stands alone, rows are equal, or the depth is that of a balanced tree."""
    feature, cut, left, right, path = [], [], [], [], []

    def node(part: np.ndarray, depth: int, most: int) -> int:
        me = len(feature)
        feature.append(-1), cut.append(0.0), left.append(me), right.append(me)
        path.append(depth + average_path(len(part)))
        low, high = part.min(axis=0), part.max(axis=0)
        spread = np.flatnonzero(high > low)
        if depth < most and len(spread):
            f = int(rng.choice(spread))
            at = rng.uniform(low[f], high[f])
            below = part[:, f] <= at
            if below.all():  # rounding put the cut on the largest value
                below = part[:, f] < high[f]
                at = part[below, f].max()
            feature[me], cut[me] = f, at
            left[me] = node(part[below], depth + 1, most)
            right[me] = node(part[~below], depth + 1, most)
        return me

    node(sample, 0, int(np.ceil(np.log2(max(2, len(sample))))))
    return {"feature": np.array(feature), "cut": np.array(cut), "left": np.array(left), "right": np.array(right), "path": np.array(path)}


def grow_forest(pool: np.ndarray, trees: int, tree_rows: int, seed: int) -> list[dict[str, np.ndarray]]:
    rng = np.random.default_rng(seed)
    size = min(tree_rows, len(pool))
    return [grow_tree(pool[rng.choice(len(pool), size, replace=False)], rng) for _ in range(trees)] if size else []


def forest_scores(stats: np.ndarray, forest: list[dict[str, np.ndarray]], size: int) -> np.ndarray:
    """Anomaly score between 0 and 1: 2 to the power of minus the mean path over the usual path."""
    if not forest or not len(stats):
        return np.zeros(len(stats))
    total = np.zeros(len(stats))
    row = np.arange(len(stats))
    for tree in forest:
        at = np.zeros(len(stats), dtype=np.int64)
        for _ in range(64):
            f = tree["feature"][at]
            if (f < 0).all():
                break
            go_left = stats[row, np.maximum(f, 0)] <= tree["cut"][at]
            at = np.where(go_left, tree["left"][at], tree["right"][at])  # a leaf points at itself
        total += tree["path"][at]
    return 2.0 ** (-total / len(forest) / max(average_path(size), 1e-9))


def verdict_bin(histogram: list[tuple[int, int, int]], bins: int, most_good_loss: float) -> int:
    """Lowest bin from which documents go: best recall of bad labels less share of good ones lost, within the limit."""
    good, bad = np.zeros(bins + 1), np.zeros(bins + 1)
    for b, label, n in histogram:
        (good if label else bad)[b] += n
    if not good.sum() or not bad.sum():
        return bins + 1
    lost = np.cumsum(good[::-1])[::-1] / good.sum()
    caught = np.cumsum(bad[::-1])[::-1] / bad.sum()
    value = np.where(lost <= most_good_loss, caught - lost, 0.0)
    best = int(value.argmax())
    return best if value[best] > 0 else bins + 1


def calibrated_forest(counts: DataFrame, labels: DataFrame, trees: int, tree_rows: int, bins: int, most_good_loss: float, seed: int):
    """(forest, rows of a tree, first bin that goes), from rule counts of all documents and all labelled rows."""
    order, wanted = F.xxhash64("doc_id", F.lit(seed)), trees * tree_rows
    # of the hash range only as much as holds about twice the pool, so that tasks send few rows
    share = min(1.0, 2 * wanted / max(1, counts.count()))
    likely = counts.filter(F.pmod(order, F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))) if share < 1 else counts
    pool = likely.orderBy(order, "doc_id", *COUNTS).limit(wanted).select(COUNTS).toPandas()
    forest = grow_forest(rule_statistics({c: pool[c].to_numpy() for c in COUNTS}), trees, tree_rows, seed) if len(pool) else []
    size = min(tree_rows, len(pool))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    labelled = counts.filter(~base_failed()).join(known.filter("label in (0, 1)"), "doc_id").select(*COUNTS, "label")
    histogram = (
        with_scores(labelled, forest, size)
        .groupBy(F.floor(F.col("score") * bins).cast("int").alias("bin"), "label")
        .count()
        .collect()  # at most two rows per bin
    )
    return forest, size, verdict_bin([tuple(r) for r in histogram], bins, most_good_loss)


def base_failed():
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEAT_PERCENT * F.col("n_words"))


def with_scores(counts: DataFrame, forest: list[dict[str, np.ndarray]], size: int) -> DataFrame:
    """The columns of counts and the forest's score."""
    shared = counts.sparkSession.sparkContext.broadcast(forest)  # trees * 2 * tree_rows nodes at most

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = rule_statistics({c: batch.column(c).to_numpy(zero_copy_only=False) for c in COUNTS})
            scores = pa.array(forest_scores(stats, shared.value, size))
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, "score"])

    return counts.mapInArrow(score, StructType([*counts.schema.fields, StructField("score", DoubleType())]))


def quality_verdicts(
    docs: DataFrame, labels: DataFrame, trees: int = 100, tree_rows: int = 256, bins: int = 1000, most_good_loss: float = 0.02, seed: int = 7
) -> DataFrame:
    """doc_id, COUNTS, score, base_failed and kept for every row of docs(doc_id, text)."""
    counts = pin(rule_counts(docs), "rule-counts")
    forest, size, least = calibrated_forest(counts, labels, trees, tree_rows, bins, most_good_loss, seed)
    scored = with_scores(counts, forest, size).withColumn("base_failed", base_failed())
    return scored.withColumn("kept", ~F.col("base_failed") & (F.floor(F.col("score") * bins) < least))


def keep_good(
    docs: DataFrame, labels: DataFrame, trees: int = 100, tree_rows: int = 256, bins: int = 1000, most_good_loss: float = 0.02, seed: int = 7
) -> DataFrame:
    """Rows of docs that the rules keep, every column as it was; texts are judged in place and never shuffled."""
    counts = pin(rule_counts(docs), "rule-counts")
    forest, size, least = calibrated_forest(counts, labels, trees, tree_rows, bins, most_good_loss, seed)
    shared = docs.sparkSession.sparkContext.broadcast(forest)
    column = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = np.array([text_counts(t.as_py(), hashes) for t in batch.column(column)], dtype=np.int64).reshape(-1, len(COUNTS))
            c = dict(zip(COUNTS, found.T, strict=True))
            failed = (c["n_words"] < LEAST_WORDS) | (100 * c["n_repeat_words"] > MOST_REPEAT_PERCENT * c["n_words"])
            bin_of = np.floor(forest_scores(rule_statistics(c), shared.value, size) * bins)
            yield batch.filter(pa.array(~failed & (bin_of < least)))

    return docs.mapInArrow(keep, docs.schema)
