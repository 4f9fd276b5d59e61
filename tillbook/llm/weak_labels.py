"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on every document. Expectation-maximisation over the counts of vote
patterns (all documents; at most 3 to the number of labellers patterns) estimates how each labeller votes on good
and on bad documents and the share of good ones; the posterior of a pattern is its documents' label. A hashed
linear scorer (word and word-shape features) is fitted to the posteriors of at most `fit_rows` documents, picked
by hash, in one task. It scores every document; the threshold is calibrated on all labelled rows by a histogram.

Defined cases: a null text is empty, draws the votes of an empty text and scores by the bias; a null doc_id is
allowed; every row gives a row; without documents nothing is fitted and nothing returned; without labels of both
kinds the threshold is 0.5; patterns with equal counts are summed, equal scores share a verdict.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.quality_rules import COUNTS, text_counts, verdict_bin
from tillbook.llm.text import CACHED_WORDS, WordHashes
from tillbook.session import pin

FEATURE_BITS = 18
BINS = 1000

# Frequent function words of the languages that the corpus is written in.
FUNCTION_WORDS = frozenset(
    b"a and are as at be by for from in is it of on that the this to was with "
    b"au avec ce dans de des du elle en est et il la le les ne pas pour que qui sur un une "
    b"auf das dem den der des die ein eine ist im mit nicht sich und von zu "
    b"al como con del el ella es lo los las no por que se su una y".split()
)

LABELLERS = ["symbols", "capitals", "repeats", "lines", "stutter", "word_length", "size", "function_words"]


def votes(counts: tuple[int, ...], function_words: int) -> tuple[int, ...]:
    """A vote per labeller: 1 good, -1 bad, 0 none."""
    c = dict(zip(COUNTS, counts, strict=True))
    n, chars, lines = max(1, c["n_words"]), max(1, c["word_chars"]), max(1, c["n_lines"])
    length, stop = c["word_chars"] / n, function_words / n

    def between(value: float, good: float, bad: float) -> int:
        return 1 if value <= good else -1 if value >= bad else 0

    return (
        between(c["n_symbols"] / chars, 0.005, 0.05),
        between(c["n_upper"] / chars, 0.06, 0.3),
        between(c["n_repeat_words"] / n, 0.02, 0.3),
        -1 if c["n_dup_lines"] / lines >= 0.3 else 0,
        between(c["n_adjacent"] / n, 0.02, 0.1),
        between(abs(np.log(max(length, 0.1) / 5)), 0.2, 0.45),
        -1 if c["n_words"] < 20 else 1 if 50 <= c["n_words"] <= 20_000 else 0,
        between(-stop, -0.1, -0.03),
    )


def vote_rows(docs: DataFrame) -> DataFrame:
    """doc_id, pattern (a number in base 3) and bucket (hash of the id and text) of every row."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        power = 3 ** np.arange(len(LABELLERS))
        for batch in batches:
            ids, texts, marks = batch.columns
            patterns = []
            for t in texts:
                text = t.as_py()
                found = sum(map(FUNCTION_WORDS.__contains__, text.encode().lower().split())) if text else 0
                patterns.append(int((np.array(votes(text_counts(text, hashes), found)) + 1) @ power))
            yield pa.RecordBatch.from_arrays([ids, pa.array(patterns, pa.int32()), marks], ["doc_id", "pattern", "mark"])

    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", mark())
    return marked.mapInArrow(made, "doc_id long, pattern int, mark long")


def mark():
    """What picks a row for fitting, independent of the order of rows."""
    return F.xxhash64("doc_id", "text").alias("mark")


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of good per pattern, P(vote | class) as [class, labeller, vote + 1], share of good documents."""
    digits = (patterns[:, None] // 3 ** np.arange(len(LABELLERS))) % 3
    good = 1 / (1 + np.exp(-1.5 * (digits - 1).sum(axis=1)))  # start: the majority
    rates = np.zeros((2, len(LABELLERS), 3))
    share = 0.5
    for _ in range(rounds):
        weight = np.stack([(1 - good) * counts, good * counts])
        for vote in range(3):
            rates[:, :, vote] = weight @ (digits == vote) + 0.5
        rates /= rates.sum(axis=2, keepdims=True)
        share = float((weight[1].sum() + 1) / (counts.sum() + 2))
        logs = np.log(rates)[:, np.arange(len(LABELLERS)), digits].sum(axis=2)
        before, good = good, 1 / (1 + np.exp(np.clip(logs[0] - logs[1] + np.log((1 - share) / share), -500, 500)))
        if np.abs(good - before).max() < 1e-9:
            break
    return good, rates, share


# ------------------------------------------------------------------ hashed linear scorer
# Shape of a word: letters (all bytes of other scripts among them) a, capitals A, digits 0, runs as one.
SHAPES = bytes(0x41 if 0x41 <= b <= 0x5A else 0x30 if 0x30 <= b <= 0x39 else 0x61 if 0x61 <= b <= 0x7A or b >= 0x80 else b for b in range(256))
RUN = re.compile(rb"(.)\1+", re.DOTALL)


class Features(dict):
    """Feature numbers of a word: its hash and the hash of its shape, as one integer."""

    def __missing__(self, word: bytes) -> int:
        shape = RUN.sub(rb"\1", word.translate(SHAPES))
        low = (1 << FEATURE_BITS) - 1
        value = (xxhash.xxh64_intdigest(word.lower()) & low) << 32 | (xxhash.xxh64_intdigest(shape, 1) & low)
        if len(self) < CACHED_WORDS:
            self[word] = value
        return value

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers and values of a text, of length 1 as a vector."""
        found = text.encode().split() if text else []
        both = np.fromiter(map(self.__getitem__, found), dtype=np.int64, count=len(found))
        index, count = np.unique(np.concatenate([both >> 32, both & 0xFFFFFFFF]), return_counts=True)
        value = np.log1p(count)
        return index, value / max(1e-9, float(np.sqrt((value**2).sum())))


def fit(texts: list[str | None], target: np.ndarray, epochs: int = 6, rate: float = 0.5, decay: float = 1e-6, seed: int = 11) -> np.ndarray:
    """Weights and bias of logistic regression on soft labels, by adaptive stochastic gradients; classes weigh alike."""
    features = Features()
    rows = [features.of(t) for t in texts]
    weights, squares = np.zeros((1 << FEATURE_BITS) + 1), np.full((1 << FEATURE_BITS) + 1, 1e-6)
    mean = float(np.clip(target.mean(), 0.01, 0.99)) if len(target) else 0.5
    importance = target / (2 * mean) + (1 - target) / (2 * (1 - mean))
    rng = np.random.default_rng(seed)
    for _ in range(epochs if rows else 0):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 64):
            part = order[at : at + 64]
            index = np.concatenate([np.r_[rows[i][0], 1 << FEATURE_BITS] for i in part])
            value = np.concatenate([np.r_[rows[i][1], 1.0] for i in part])
            owner = np.repeat(np.arange(len(part)), [len(rows[i][0]) + 1 for i in part])
            z = np.bincount(owner, weights=weights[index] * value, minlength=len(part))
            error = (1 / (1 + np.exp(-z)) - target[part]) * importance[part]
            touched, inverse = np.unique(index, return_inverse=True)
            gradient = np.bincount(inverse, weights=error[owner] * value) / len(part) + decay * weights[touched]
            squares[touched] += gradient**2
            weights[touched] -= rate * gradient / np.sqrt(squares[touched])
    return weights


def _fitted(docs: DataFrame, posterior: DataFrame, fit_rows: int, total: int) -> np.ndarray:
    """Weights fitted in one task on at most fit_rows rows, those with the smallest marks."""
    share = min(1.0, 2 * fit_rows / max(1, total))
    picked = docs.select("text", mark())
    if share < 1:
        limit = int(-(2**63) + share * 2.0**64)
        picked, posterior = picked.filter(F.col("mark") < limit), posterior.filter(F.col("mark") < limit)
    # a repeated row has one mark and counts once
    labelled = picked.dropDuplicates(["mark"]).join(posterior.groupBy("mark").agg(F.max("good").alias("good")), "mark")
    sample = labelled.orderBy("mark").limit(fit_rows).select("text", "good")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, target = [], []
        for batch in batches:
            texts.extend(batch.column(0).to_pylist())
            target.extend(batch.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([fit(texts, np.array(target, dtype=np.float64))], pa.list_(pa.float64()))], ["weights"])

    found = sample.coalesce(1).mapInArrow(train, "weights array<double>").toArrow()
    return np.array(found.column(0)[0].as_py()) if found.num_rows else np.zeros((1 << FEATURE_BITS) + 1)


def quality_scores(docs: DataFrame, labels: DataFrame, fit_rows: int = 8_000, most_good_loss: float = 0.02) -> DataFrame:
    """doc_id, weak_label (posterior of good), score (good at 1) and kept of every row of docs(doc_id, text)."""
    spark = docs.sparkSession
    voted = pin(vote_rows(docs), "votes")
    table = sorted((r[0], r[1]) for r in voted.groupBy("pattern").count().collect())  # at most 3 ** len(LABELLERS) rows
    patterns, counts = (np.array(c, dtype=np.int64) for c in (zip(*table, strict=True) if table else ([], [])))
    good = expectation_maximisation(patterns, counts)[0] if table else np.empty(0)
    known = spark.createDataFrame([(int(p), float(g)) for p, g in zip(patterns, good, strict=True)], "pattern int, good double")
    posterior = voted.join(F.broadcast(known), "pattern").select("mark", "good")
    weights = spark.sparkContext.broadcast(_fitted(docs, posterior, fit_rows, int(counts.sum())))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, w = Features(), weights.value
        for batch in batches:
            scores = []
            for t in batch.column(1):
                index, value = features.of(t.as_py())
                scores.append(1 / (1 + np.exp(-np.clip(w[index] @ value + w[-1], -500, 500))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(scores, pa.float64())], ["doc_id", "mark", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", mark()).mapInArrow(score, "doc_id long, mark long, score double")
    scored = pin(scored, "weak-scores")
    truth = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label")).filter("label in (0, 1)")
    worst = F.floor((1 - F.col("score")) * BINS).cast("int")
    histogram = scored.select("doc_id", worst.alias("bin")).join(truth, "doc_id").groupBy("bin", "label").count().collect()
    least = verdict_bin([tuple(r) for r in histogram], BINS, most_good_loss)
    kept = worst < (least if least <= BINS else BINS // 2)
    label = posterior.groupBy("mark").agg(F.max("good").alias("weak_label"))
    return scored.join(label, "mark").select("doc_id", "weak_label", "score", kept.alias("kept"))
