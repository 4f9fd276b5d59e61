"""Byte-level BPE encoding and decoding by DuckDB recursive queries inside Spark tasks.

Text is cut by the tokenizer's pattern; each distinct piece of a batch becomes token-position rows, and a recursive
query joins neighbouring rows with the merge table and contracts each piece's leftmost pair of least rank until no pair
is left. A piece of more than LONG bytes contracts all places of its least pair that do not overlap in one step, which
comes to the same and needs fewer steps. Decoding joins ids with the vocabulary and aggregates bytes by position.

A task works through its rows batch by batch: words already met come from a cache of fixed size, new words are encoded
WORDS at a time, and a query runs STEPS steps before the rest goes into the next one, so memory does not follow
the input. The vocabulary file is read once on the driver and sent to the executors (its size is the vocabulary's).

Defined cases: a null text is empty; an empty text has no ids and decodes to nothing; special tokens are ordinary text;
repeated rows each give a row; an id that the vocabulary lacks fails the query.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LONG = 64
WORDS = 40_000
STEPS = 64
CACHED_CHUNKS = 800_000
IDS_AT_ONCE = 2_000_000

# Every character that counts as white space, the space itself among them.
SPACES = frozenset(filter(str.isspace, map(chr, range(sys.maxunicode + 1))))

# k holds rank, position and length of the left token, so that the least k is the leftmost pair of least rank.
LEFTMOST = """
with recursive s(w, p, t, best, step) as (
  select w, p, t, 0::bigint, 0 from tokens
  union all
  select w, p, case when k = best then (best >> 40)::integer else t end, best, step from (
    with x as materialized (
      select n.w, n.p, n.t, n.step, m.k | (n.p::bigint << 8) as k
      from (select w, p, t, step + 1 as step, lead(t) over (partition by w order by p) as next
            from s where best is not null and step < $steps) n
      left join merges m on m.l = n.t and m.r = n.next)
    select x.*, b.best from x join (select w, min(k) as best from x group by w) b using (w))
  where best is null or p <> ((best >> 8) & 4294967295) + (best & 255)
)
select w, p, t, best is null as done from s where best is null or step = $steps
"""

EVERYWHERE = """
with recursive s(w, p, t, best, step) as (
  select w, p, t, 0::bigint, 0 from tokens
  union all
  select w, p, case when hit then best::integer else t end, best, step from (
    select w, p, t, best, step, hit, coalesce(lag(hit) over (partition by w order by p), false) as eaten from (
      select w, p, t, best, step, i,
        fits and (i - min(i) over (partition by w, fits, island)) % 2 = 0 as hit
      from (
        select *, i - row_number() over (partition by w, fits order by p) as island from (
          select *, coalesce(k = best, false) as fits, row_number() over (partition by w order by p) as i from (
            select n.w, n.p, n.t, n.step, m.k >> 40 as k, min(m.k >> 40) over (partition by n.w) as best
            from (select w, p, t, step + 1 as step, lead(t) over (partition by w order by p) as next
                  from s where best is not null and step < $steps) n
            left join merges m on m.l = n.t and m.r = n.next)))))
  where not eaten
)
select w, p, t, best is null as done from s where best is null or step = $steps
"""

DECODE = """
select d, string_agg(v.bytes, '' order by p) as text, count(*) - count(v.bytes) as unknown
from ids left join vocabulary v using (t) group by d
"""


class ByteBPE:
    """Merge table and vocabulary of a rank file in one in-memory DuckDB, with a cache of encoded words."""

    def __init__(self, ranks_file: bytes, pattern: str):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines()) if a}
        merges = [
            (ranks[token[:i]], ranks[token[i:]], (rank << 40) | i)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "preserve_insertion_order": False})
        l, r, k = (np.array(c, dtype=np.int64) for c in (zip(*merges, strict=True) if merges else ([], [], [])))
        self._load("merges", pa.table({"l": pa.array(l, pa.int32()), "r": pa.array(r, pa.int32()), "k": pa.array(k, pa.int64())}))
        # a byte is written as the character of the same number, so that text functions work on bytes
        self._load(
            "vocabulary",
            pa.table({"t": pa.array(list(ranks.values()), pa.int32()), "bytes": pa.array([t.decode("latin-1") for t in ranks], pa.string())}),
        )
        self.whole = ranks
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.pattern = regex.compile(pattern)
        self.clear()

    def _load(self, name: str, data: pa.Table) -> None:
        self.con.register("arriving", data)
        self.con.execute(f"create or replace table {name} as select * from arriving")
        self.con.unregister("arriving")

    # ---------------------------------------------------------------- pieces of the pattern
    def _contract(self, words: list[bytes], query: str) -> list[np.ndarray]:
        """Ids of each word by the recursive query, repeated until every word is at its fixpoint."""
        sizes = np.array([len(w) for w in words])
        ends = np.cumsum(sizes)
        w = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        p = (np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)).astype(np.int64)
        t = self.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
        found = []
        while len(w):
            self._load("tokens", pa.table({"w": w, "p": p, "t": t}))
            out = self.con.sql(query.replace("$steps", str(STEPS))).to_arrow_table()
            w, p, t, done = (out.column(c).to_numpy() for c in ("w", "p", "t", "done"))
            found.append((w[done], p[done], t[done]))
            w, p, t = w[~done], p[~done], t[~done]
        w, p, t = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.lexsort((p, w))
        w, t = w[order], t[order].astype(np.uint32)
        cuts = np.searchsorted(w, np.arange(len(words) + 1)).tolist()
        return [t[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.empty(0, dtype=np.uint32)] * len(words)
        open_ = []
        for i, word in enumerate(words):
            if word in self.whole:
                out[i] = np.array([self.whole[word]], dtype=np.uint32)
            else:
                open_.append(i)
        for long in (False, True):
            part = [i for i in open_ if (len(words[i]) > LONG) == long]
            while part:
                now, size = [], 0
                while part and len(now) < WORDS and (not now or size + len(words[part[-1]]) <= 12 * WORDS):
                    size += len(words[part[-1]])
                    now.append(part.pop())
                for i, ids in zip(now, self._contract([words[i] for i in now], EVERYWHERE if long else LEFTMOST), strict=True):
                    out[i] = ids
        return out

    # ---------------------------------------------------------------- texts
    def clear(self) -> None:
        self.chunks: dict[str, int] = {}
        self.sizes, self.starts, self.flat, self.filled = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint32), 0

    def _learn(self, fresh: list[str]) -> None:
        """Encode chunks of text that are not in the cache."""
        pieces = [self.pattern.findall(c) for c in fresh]
        ids: dict[str, np.ndarray] = {}
        words = []
        for p in dict.fromkeys(p for found in pieces for p in found):
            at = self.chunks.get(p)  # most pieces are a chunk of their own somewhere
            if at is None:
                words.append(p)
            else:
                ids[p] = self.flat[self.starts[at] : self.starts[at] + self.sizes[at]]
        ids.update(zip(words, self.encode_words([w.encode() for w in words]), strict=True))
        found = [ids[p] for c in pieces for p in c]
        ends = np.r_[0, np.cumsum([len(f) for f in found], dtype=np.int64)]
        sizes = np.diff(ends[np.r_[0, np.cumsum([len(c) for c in pieces], dtype=np.int64)]])
        starts = len(self.flat) + np.cumsum(sizes) - sizes
        at = len(self.chunks)
        self.chunks.update(zip(fresh, range(at, at + len(fresh)), strict=True))
        self.sizes, self.starts = np.concatenate([self.sizes, sizes]), np.concatenate([self.starts, starts])
        self.flat = np.concatenate([self.flat, *found])

    def cut(self, text: str) -> list[str]:
        """Chunks whose pieces, one after the other, are the pieces of the text.

        The pattern always starts a piece at a single space between two characters that are not white space.
        Where a space has other white space beside it, the text from the character before is left uncut.
        """
        first, *rest = text.split(" ")
        if not any(c in text and (c + " " in text or " " + c in text) for c in SPACES):
            return [first, *[" " + r for r in rest]]
        out = [first]
        for i, r in enumerate(rest):
            left = first if i == 0 else rest[i - 1]
            if left and r and left[-1] not in SPACES and r[0] not in SPACES:
                out.append(" " + r)
            else:
                out[-1] += " " + r
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, without special tokens."""
        if len(self.chunks) > CACHED_CHUNKS:
            self.clear()
        cut = [self.cut(t) if t else [] for t in texts]
        fresh = {c for chunks in cut for c in chunks if c not in self.chunks}
        if fresh:
            self._learn(list(fresh))
        out = []
        for chunks in cut:
            index = np.fromiter(map(self.chunks.__getitem__, chunks), dtype=np.int64, count=len(chunks))
            sizes = self.sizes[index]
            ends = np.cumsum(sizes)
            total = int(ends[-1]) if len(ends) else 0
            out.append(self.flat[np.arange(total) + np.repeat(self.starts[index] - (ends - sizes), sizes)])
        return out

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """Bytes of each list of ids."""
        out = [b""] * len(ids)
        at = 0
        while at < len(ids):
            end, total = at, 0
            while end < len(ids) and (end == at or total + len(ids[end]) <= IDS_AT_ONCE):
                total += len(ids[end])
                end += 1
            part = ids[at:end]
            sizes = np.array([len(i) for i in part])
            starts = np.cumsum(sizes) - sizes
            flat = np.concatenate(part).astype(np.int32)
            d = np.repeat(np.arange(at, end, dtype=np.int32), sizes)
            self._load("ids", pa.table({"d": d, "p": np.arange(total) - np.repeat(starts, sizes), "t": flat}))
            for doc, text, unknown in self.con.execute(DECODE).fetchall():
                if unknown:
                    raise ValueError(f"{unknown} ids are not in the vocabulary")
                out[doc] = text.encode("latin-1")
            at = end
        return out


_tokenizers: dict[tuple, ByteBPE] = {}


def tokenizer(ranks_file: bytes, pattern: str) -> ByteBPE:
    """One tokenizer per Python worker, kept for its later tasks."""
    key = (hash(ranks_file), pattern)
    if key not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[key] = ByteBPE(ranks_file, pattern)
    return _tokenizers[key]


def _sent(spark: SparkSession, path: str):
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit integers) of every row of docs(doc_id, text)."""
    ranks = _sent(docs.sparkSession, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(ranks.value, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids = bpe.encode([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(i) for i in ids], pa.int64()), pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary())],
                    ["doc_id", "n_tokens", "ids"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """The columns doc_id, n_tokens, ids of encode() and the decoded bytes."""
    ranks = _sent(encoded.sparkSession, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(ranks.value, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                found = bpe.decode([np.frombuffer(i or b"", dtype="<u4") for i in part.column(2).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.binary())], ["doc_id", "n_tokens", "ids", "decoded"])

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids, ids_sha256 and decoded_sha256 of every row: encode() and decode() in one pass."""
    ranks = _sent(docs.sparkSession, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(ranks.value, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids = bpe.encode([t or "" for t in part.column(1).to_pylist()])
                packed = [i.astype("<u4").tobytes() for i in ids]
                decoded = bpe.decode(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(i) for i in ids], pa.int64()),
                        pa.array(packed, pa.binary()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in packed], pa.string()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"],
                )

    schema = "doc_id long, n_tokens long, ids binary, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
