import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from llm_data import SF, documents, llm, nothing, odd, odd_rows  # noqa: F401

from tillbook.llm import katz


def brute(rows):
    """Scores straight from the definition, one probability per token."""

    def tokens(text):
        return [*(text or "").encode().lower().split(), "end"]

    def out(doc):
        return doc is not None and zlib.crc32(str(doc).encode()) % 5 == 1

    unigrams, pairs = Counter(), Counter()
    for doc, text in rows:
        if not out(doc):
            w = tokens(text)
            unigrams.update(w)
            pairs.update(zip(["start", *w[:-1]], w, strict=True))

    def discount(counts):
        d = katz.discounts(Counter(counts.values()))
        return (lambda c: c * (d[c] if c < len(d) else 1)) if len(d) else (lambda c: c - 0.5)

    d1, d2 = discount(unigrams), discount(pairs)
    total, size = sum(unigrams.values()), len(unigrams)
    unknown = 1 - sum(d1(c) for c in unigrams.values()) / total

    def single(w):
        return d1(unigrams[w]) / total if w in unigrams else unknown

    after = defaultdict(dict)
    for (h, w), c in pairs.items():
        after[h][w] = c
    weights = {}
    for h, seen in after.items():
        c = sum(seen.values())
        left = sum(n - d2(n) for n in seen.values())
        if left < 1e-9:
            left, c = 1, c + 1
        weights[h] = c, left / c / (1 - sum(single(w) for w in seen))

    def probability(h, w):
        if h not in after:
            return single(w)
        c, alpha = weights[h]
        return d2(after[h][w]) / c if w in after[h] else alpha * single(w)

    result = []
    for doc, text in rows:
        w = tokens(text)
        base = sum(math.log10((unigrams[x] + 0.5) / (total + 0.5 * (size + 1))) for x in w)
        score = sum(math.log10(probability(h, x)) for h, x in zip(["start", *w[:-1]], w, strict=True))
        result.append((doc, out(doc), len(w), sum(x in unigrams for x in w), total, round(base, 4), round(score, 4)))
    mass = [sum(probability(h, w) for w in unigrams) + probability(h, "unknown word") for h in list(after)[:20]]
    return sorted(result, key=repr), mass


def collected(df):
    return sorted(((r[0], r[1], r[2], r[3], r[4], round(r[5], 4), round(r[6], 4)) for r in df.collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"hot_words": 60, "hot_pairs": 20, "blocks": 3}])
def test_scores_equal_the_definition(llm, documents, options, monkeypatch):
    if options:  # several buckets and chunks, most words rare
        monkeypatch.setattr(katz, "BUCKET_BYTES", 20_000)
        monkeypatch.setattr(katz, "COUNT_TOKENS", 4_000)
        monkeypatch.setattr(katz, "SCORE_TOKENS", 3_000)
    docs = llm.read.parquet(f"{SF}/documents.parquet").repartition(5)
    expected, mass = brute(documents)
    assert collected(katz.scores(docs, **options)) == expected
    assert np.allclose(mass, 1)


def test_odd_rows(odd, odd_rows):
    expected, _ = brute(odd_rows)
    assert collected(katz.scores(odd, hot_words=5, hot_pairs=2)) == expected


def test_no_rows_and_no_training_rows(llm, nothing):
    assert katz.scores(nothing).collect() == []
    held = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 5 == 1)
    rows = katz.scores(llm.createDataFrame([(held, "some words")], "doc_id long, text string")).collect()
    assert [tuple(r) for r in rows] == [(held, True, 3, 0, 0, 0.0, 0.0)]


def test_triples_by_one_number_and_by_three():
    rng = np.random.default_rng(2)
    h, w, doc = (rng.integers(0, n, 3000) for n in (6, 7, 5))
    small, large = katz.distinct_triples(h, w, doc, 8, 5), katz.distinct_triples(h, w, doc, 1 << 30, 1 << 10)
    assert all((a == b).all() for a, b in zip(small, large, strict=True))
    assert dict(zip(zip(*small[:3], strict=True), small[3], strict=True)) == Counter(zip(h, w, doc, strict=True))
    none = np.empty(0, np.int64)
    assert all(len(x) == 0 for words in (8, 1 << 30) for x in katz.distinct_triples(none, none, none, words, 1 << 10))


def test_discounts_fall_back():
    assert len(katz.discounts({1: 10})) == 0
    assert len(katz.discounts({1: 100, 2: 40, 3: 20, 4: 12, 5: 8, 6: 6})) == 6
    d = katz.discounts({1: 100, 2: 40, 3: 20})
    assert 1 < len(d) <= 3 and all(0 < x < 1 for x in d[1:])


def test_tokens_are_numbered_by_distinct_words():
    """Words split and lower-cased as bytes are, numbered once a chunk, so that only distinct ones are hashed in Python."""
    texts = ["  A b\tA\x0b\x0cÀ\x1cx \r\n", None, "", " ", "\x85 one\u00a0two \u2003", "b", "a " * 50]
    w, h, doc, hashes = katz.tokens(pa.array(texts))
    end, start = len(hashes) - 2, len(hashes) - 1
    assert hashes[[end, start]].tolist() == [katz.END, katz.START]
    expected = [[xxhash.xxh64_intdigest(x) for x in (t or "").encode().lower().split()] + [katz.END] for t in texts]
    assert [hashes[w[doc == i]].tolist() for i in range(len(texts))] == expected
    assert [hashes[h[doc == i]].tolist() for i in range(len(texts))] == [[katz.START, *x[:-1]] for x in expected]
    assert len(set(hashes.tolist())) == len(hashes)


def test_chunks_hold_every_row_in_order():
    texts = [None if i % 7 == 0 else "word " * (i % 5 * 10) for i in range(200)]
    parts = [pa.RecordBatch.from_arrays([pa.array(range(a, b)), pa.array(texts[a:b], pa.string())], ["row", "text"]) for a, b in ((0, 90), (90, 90), (90, 200))]
    chunks = list(katz._chunks(iter(parts), 1, 100))
    assert [r for rows, _ in chunks for r in rows.to_pylist()] == list(range(200))
    assert [t for _, column in chunks for t in column.to_pylist()] == texts
    sizes = [sum(len(t or "") // 6 + 1 for t in column.to_pylist()) for _, column in chunks]
    assert all(100 <= n <= 100 + 35 for n in sizes[:-1])
    assert list(katz._chunks(iter([]), 1, 100)) == []


def test_counts_beyond_32_bits_travel_as_the_largest(llm):
    cells = llm.sql("select try_cast(array(1L, 3000000000L, 2147483647L) as array<int>) n").toArrow().column(0).combine_chunks()
    assert katz._arrays(cells[0], katz.MOST).tolist() == [1, katz.MOST, katz.MOST]
