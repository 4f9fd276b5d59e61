"""Substring dedup over sliding runs of sentences.

A sentence ends with a line, with a word that ends in . ! ? , ; or :, or with one word in sixteen picked by its hash,
so that text without punctuation is cut at the same words wherever it stands. From every sentence the shortest run
of at least `run_sentences` sentences and `run_words` words is hashed (A-Z in lower case, white space aside). A run that
stands in several documents is kept in the one with the smallest doc_id; a run that a document repeats is
kept once. Sentences covered by any other repeated run are removed.

Spark sees one row per distinct run of a document and needs only the smallest doc_id per hash, an aggregate that
is combined before the shuffle; the join that finds the runs of later documents is one that Spark splits at
frequent runs. Neither collects the documents of a run.

Defined cases: null texts stay null; empty texts and texts shorter than a run stay; rows of one doc_id count as one
document, so a repeated row takes nothing from its twin; rows without an id are compared with nothing but themselves.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.text import CACHED_WORDS, mixed, signed
from tillbook.session import pin

RUN_SENTENCES, RUN_WORDS = 3, 12
ENDS = frozenset(b".!?,;:")
WORD = re.compile(r"[^\x20\x09-\x0D]+")

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


class SentenceWords(dict):
    """Hash of a word; its lowest bit says whether the word ends a sentence."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        last = word[-1] in ENDS or value >> 60 == 0
        value = value & ~1 | last
        if len(self) < CACHED_WORDS:
            self[word] = value
        return value


class Runs:
    """Sentences and run hashes of texts, with the powers that the running hash needs."""

    def __init__(self, run_sentences: int = RUN_SENTENCES, run_words: int = RUN_WORDS):
        self.run_sentences, self.run_words = run_sentences, run_words
        self.hashes = SentenceWords()
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) <= n:
            size = max(n + 1, 2 * len(self.up))
            self.up, self.down = (np.cumprod(np.r_[np.uint64(1), np.full(size - 1, b, np.uint64)]) for b in (BASE, INVERSE))

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First word of each sentence (and the end), and per run: its hash, first sentence, sentence after its last."""
        found, line_ends = [], []
        for line in text.encode().lower().split(b"\n") if text else ():
            found.extend(line.split())
            line_ends.append(len(found))
        none = np.empty(0, np.int64)
        n = len(found)
        if not n:
            return np.zeros(1, np.int64), np.empty(0, np.uint64), none, none
        words = np.fromiter(map(self.hashes.__getitem__, found), dtype=np.uint64, count=n)
        last = (words & np.uint64(1)).astype(bool)
        last[np.array(line_ends)[np.array(line_ends) > 0] - 1] = True
        last[-1] = True
        bounds = np.r_[0, np.flatnonzero(last) + 1]
        # the run from sentence i ends at the first bound that is far enough in sentences and words
        ends = np.maximum(np.searchsorted(bounds, bounds[:-1] + self.run_words), np.arange(len(bounds) - 1) + self.run_sentences)
        first = np.flatnonzero(ends < len(bounds))
        ends = ends[first]
        self._powers(n)
        sums = np.r_[np.uint64(0), np.cumsum(words * self.down[:n])]
        value = (sums[bounds[ends]] - sums[bounds[first]]) * self.up[bounds[first]]
        return bounds, mixed(value + (bounds[ends] - bounds[first]).astype(np.uint64)), first, ends

    def cleaned(self, text: str, gone: np.ndarray) -> tuple[str, int, int]:
        """The text without sentences of runs in `gone` and without later copies of its own runs, sentences, removed."""
        bounds, values, first, ends = self.of(text)
        total = len(bounds) - 1
        _, earliest, index = np.unique(values, return_index=True, return_inverse=True)
        drop = np.isin(values, gone) | (earliest[index] != np.arange(len(values)))
        if not drop.any():
            return text, total, 0
        edges = np.zeros(total + 1, np.int64)
        np.add.at(edges, first[drop], 1)
        np.add.at(edges, ends[drop], -1)
        covered = np.cumsum(edges[:-1]) > 0
        starts = [m.start() for m in WORD.finditer(text)]
        cuts = [0, *(starts[b] for b in bounds[1:-1]), len(text)]
        kept = "".join(text[a:b] for a, b, c in zip(cuts, cuts[1:], covered, strict=False) if not c)
        return kept, total, int(covered.sum())


def occurrences(docs: DataFrame, run_sentences: int, run_words: int) -> DataFrame:
    """doc_id, run: each distinct run hash of every row with an id."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Runs(run_sentences, run_words)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                ids, texts = batch.slice(at, 1024).columns
                found = [np.unique(runs.of(t.as_py())[1]) for t in texts]
                doc = np.repeat(ids.to_numpy(zero_copy_only=False), [len(f) for f in found])
                values = signed(np.concatenate(found)) if found else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(values, pa.int64())], ["doc_id", "run"])

    known = docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), "text")
    return known.mapInArrow(made, "doc_id long, run long")


def later_runs(docs: DataFrame, run_sentences: int, run_words: int) -> DataFrame:
    """doc_id and the array of its runs that a document with a smaller id has too."""
    found = pin(occurrences(docs, run_sentences, run_words), "runs")
    owners = found.groupBy("run").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))
    repeated = pin(owners.filter("owner <> last").select("run", "owner"), "repeated-runs")
    later = found.join(repeated, "run").filter("doc_id <> owner")
    return later.groupBy("doc_id").agg(F.collect_set("run").alias("runs"))  # bounded by one document


def without_repeats(docs: DataFrame, run_sentences: int = RUN_SENTENCES, run_words: int = RUN_WORDS) -> DataFrame:
    """doc_id, text without repeated runs, n_sentences and n_removed of every row of docs(doc_id, text)."""
    gone = pin(later_runs(docs, run_sentences, run_words), "later-runs").select(F.col("doc_id").alias("_doc"), "runs")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Runs(run_sentences, run_words)
        none = np.empty(0, np.uint64)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                ids, texts, lists = batch.slice(at, 1024).columns
                out = []
                for t, g in zip(texts, lists, strict=True):
                    text = t.as_py()
                    own = g.values.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) if g.is_valid else none
                    out.append(runs.cleaned(text, own) if text else (text, 0, 0))
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())],
                    ["doc_id", "text", "n_sentences", "n_removed"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    joined = rows.join(gone, rows["doc_id"] == gone["_doc"], "left").select("doc_id", "text", "runs")
    return joined.mapInArrow(clean, "doc_id long, text string, n_sentences long, n_removed long")
