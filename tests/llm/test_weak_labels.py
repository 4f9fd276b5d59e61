import numpy as np
from llm_data import documents, llm, nothing, odd, odd_rows  # noqa: F401

from tillbook.llm import weak_labels


def test_expectation_maximisation_recovers_the_labellers():
    rng = np.random.default_rng(5)
    m = len(weak_labels.LABELLERS)
    good = rng.random(20_000) < 0.7
    accuracy = np.array([0.95, 0.9, 0.85, 0.8, 0.75, 0.7, 0.65, 0.55])
    right = rng.random((len(good), m)) < accuracy
    silent = rng.random((len(good), m)) < 0.3
    vote = np.where(silent, 1, np.where(right == good[:, None], 2, 0))
    patterns, index, counts = np.unique(vote @ 3 ** np.arange(m), return_inverse=True, return_counts=True)
    posterior, rates, share = weak_labels.expectation_maximisation(patterns, counts)
    assert abs(share - 0.7) < 0.03
    estimated = rates[1, :, 2] / (rates[1, :, 0] + rates[1, :, 2])
    assert np.abs(estimated - accuracy).max() < 0.05
    assert ((posterior[index] > 0.5) == good).mean() > ((vote - 1).sum(axis=1) > 0).astype(float).__eq__(good).mean() - 0.01


def test_held_out_accuracy(llm):
    folder = "/root/testdata/sf0.01"
    docs, labels = (llm.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    seen, held = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1")
    out = weak_labels.quality_scores(docs, seen, fit_rows=600)
    assert out.count() == docs.count()
    rows = out.join(held, "doc_id").select("quality", "kept", "score").collect()
    assert np.mean([r.kept == bool(r.quality) for r in rows]) > 0.93
    assert np.mean([r.kept for r in rows if r.quality]) > 0.95


def test_repeated_run_gives_the_same(llm):
    folder = "/root/testdata/sf0.001"
    docs, labels = (llm.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    a, b = (sorted(tuple(r) for r in weak_labels.quality_scores(docs.repartition(n), labels, fit_rows=100).collect()) for n in (1, 4))
    assert [x[0] for x in a] == [x[0] for x in b]
    assert np.allclose([x[2] for x in a], [x[2] for x in b])


def test_odd_rows(llm, odd, odd_rows, nothing):
    labels = llm.createDataFrame([(None, 1), (5, 0), (7, 1), (9, None)], "doc_id long, quality int")
    out = weak_labels.quality_scores(odd, labels)
    assert sorted((r.doc_id for r in out.collect()), key=repr) == sorted((d for d, _ in odd_rows), key=repr)
    assert weak_labels.quality_scores(nothing, labels).collect() == []
    assert weak_labels.quality_scores(odd, labels.limit(0)).count() == len(odd_rows)
