import hashlib

import numpy as np
import pytest

from conftest import rows
from llm_data import SF, llm  # noqa: F401
from tillbook.llm import vector_codes as vc

NAMES = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def brute(table, parts, entries, rounds):
    """(vec_id, code, error, label_error, digest) by plain loops over every entry."""
    kept = [(i, [int(np.floor(256 * x)) for x in v], g) for i, v, g in table if v and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0], r[1]))
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[list(row[p]) for row in cut[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for row in cut:
                groups.setdefault(nearest(row[p], books[p])[1], []).append(row[p])
            for k, found in groups.items():
                books[p][k] = [sum(c) // len(found) for c in zip(*found, strict=True)]
    best = [[nearest(row[p], books[p]) for p in range(parts)] for row in cut]
    errors = [sum(d for d, _ in b) for b in best]
    by_label = {}
    for (_, _, g), e in zip(kept, errors, strict=True):
        by_label[g] = by_label.get(g, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(
        (
            (i, "".join(f"{k:02x}" for _, k in b), e, by_label[g], digest)
            for (i, _, g), b, e in zip(kept, best, errors, strict=True)
        ),
        key=repr,
    )


@pytest.fixture(scope="module")
def odd_vectors():
    rng = np.random.default_rng(1)
    table = [(i, [float(x) for x in np.round(rng.normal(0, 0.05, 8), 2)], int(i % 3)) for i in range(60)]
    copy = table[5][1]
    table += [(1000 + i, copy, None) for i in range(40)]  # copies of one vector without a label
    table += [(7, copy, 1), (7, copy, 1)]  # one id three times
    inf, nan = float("inf"), float("nan")
    return table + [(-3, None, 1), (-2, [None] + copy[1:], 1), (-1, [nan] + copy[1:], 1), (0, [inf] + copy[1:], 2), (1, [-inf] + copy[1:], 2), (2, [], 0)]


@pytest.mark.parametrize("shape", [{"parts": 4, "entries": 8, "rounds": 2}, {"parts": 2, "entries": 200, "rounds": 1}])
def test_equals_brute_force(llm, odd_vectors, shape):  # noqa: F811
    df = llm.createDataFrame([(*r, "x", 1) for r in odd_vectors], "vec_id long, embedding array<float>, label int, code string, p int").repartition(5)
    want = brute([(i, v and [None if x is None else np.float32(x) for x in v], g) for i, v, g in odd_vectors], **shape)
    assert rows(vc.compress(df, **shape), *NAMES) == want


def test_blocks_change_nothing():
    rng = np.random.default_rng(2)
    parts, entries = rng.integers(-3, 3, (5000, 4)), rng.integers(-3, 3, (10, 4))
    trie = vc.Trie(parts)
    codes, errors = trie.nearest(entries)
    distances = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (codes[trie.leaf_of] == distances.argmin(axis=1)).all()  # ties go to the lower index
    assert (errors[trie.leaf_of] == distances.min(axis=1)).all()
    whole = vc.BLOCK
    vc.BLOCK = 3
    try:
        again = vc.Trie(parts).nearest(entries)
    finally:
        vc.BLOCK = whole
    assert (again[0] == codes).all() and (again[1] == errors).all()


def test_prefixes_are_shared():
    trie = vc.Trie(np.array([[1, 1, 1], [1, 1, 2], [1, 1, 2], [1, 2, 0], [2, 0, 0]]))
    assert [len(n) for n in trie.nodes] == [2, 3, 4]  # nodes by depth: what is added is added once for each
    assert trie.counts.tolist() == [1, 2, 1, 1]


def test_large_components_are_held(llm):  # noqa: F811
    df = llm.createDataFrame([(1, [3e38, -3e38], 1), (2, [0.0, 0.0], 1)], "vec_id long, embedding array<double>, label int")
    found = rows(vc.compress(df, parts=2, entries=2, rounds=1), "vec_id", "code", "error")
    assert found == [(1, "0000", 0), (2, "0101", 0)]


def test_floor_of_negative_means(llm):  # noqa: F811
    df = llm.createDataFrame([(1, [-1 / 256, 0.0], 1), (2, [-2 / 256, 0.0], 1)], "vec_id long, embedding array<double>, label int")
    books = vc.fit(df, parts=2, entries=1, rounds=1)
    assert books.tolist() == [[[-2]], [[0]]]  # floor(-3 / 2)


def test_other_lengths_and_empty_tables(llm):  # noqa: F811
    schema = "vec_id long, embedding array<float>, label int"
    df = llm.createDataFrame([(None, [9.0, 9.0], 1), (1, [1.0], 1), (2, [1.0, 2.0], 1), (3, [1.0, 2.0, 3.0, 4.0], 1)], schema)
    assert rows(vc.compress(df, parts=2, entries=4, rounds=1), "vec_id", "code") == [(2, "0000"), (None, "0000")]
    assert rows(vc.compress(llm.createDataFrame([], schema))) == []


def test_codes_of_the_table(llm):  # noqa: F811
    from tillbook.llm import queries

    found = queries.queries()["op11_vector_codes"](llm, SF)
    assert found.columns == NAMES
    assert found.count() == llm.read.parquet(f"{SF}/embeddings.parquet").count()
