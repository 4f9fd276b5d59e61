import numpy as np
from llm_data import SF, documents, llm, nothing, odd, odd_rows  # noqa: F401

from tillbook.llm import quality_rules
from tillbook.llm.text import WordHashes

SPACE = " \t\n\x0b\x0c\r"


def brute(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words by plain reading."""
    text = text or ""
    words, now = [], ""
    for ch in text + " ":
        if ch in SPACE:
            words += [now] if now else []
            now = ""
        else:
            now += ch
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    inside = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(8)}
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return (len(words), sum(map(len, words)), sum(ch in "#*$%&|<>" for ch in text), len(lines) - len(set(lines)), len(inside))


def failed(counts):
    return counts[0] < 20 or 100 * counts[4] > 30 * counts[0]


def base_columns(df):
    return sorted(((r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words), r.base_failed) for r in df.collect()), key=repr)


def test_counts_equal_plain_reading(llm, documents):
    docs, labels = (llm.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = quality_rules.quality_verdicts(docs, labels)
    assert base_columns(out) == sorted(((d, brute(t), failed(brute(t))) for d, t in documents), key=repr)
    assert not [r for r in out.collect() if r.kept and r.base_failed]


def test_verdicts_on_labelled_documents(llm):
    folder = "/root/testdata/sf0.01"
    docs, labels = (llm.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_rules.quality_verdicts(docs, labels).join(labels, "doc_id").filter("not base_failed").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in rows}
    assert n.get((1, False), 0) <= 0.02 * (n[1, True] + n.get((1, False), 0))
    assert n.get((0, True), 0) <= 0.1 * (n[0, False] + n.get((0, True), 0))
    kept = quality_rules.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(
        r.doc_id for r in quality_rules.quality_verdicts(docs, labels).filter("kept").select("doc_id").collect()
    )


def test_odd_rows(llm, odd, odd_rows, nothing):
    labels = llm.createDataFrame([(None, 1), (5, None), (7, 1)], "doc_id long, quality int")
    out = quality_rules.quality_verdicts(odd, labels)
    assert base_columns(out) == sorted(((d, brute(t), failed(brute(t))) for d, t in odd_rows), key=repr)
    # one kind of label only: the base rules decide alone
    assert all(r.kept != r.base_failed for r in out.collect())
    assert quality_rules.keep_good(odd, labels).columns == odd.columns
    assert quality_rules.quality_verdicts(nothing, labels).collect() == []
    assert quality_rules.keep_good(nothing, labels).collect() == []
    assert quality_rules.keep_good(odd, labels.limit(0)).count() == sum(not failed(brute(t)) for _, t in odd_rows)


def test_forest_isolates_outliers_and_takes_ties():
    rng = np.random.default_rng(3)
    usual = rng.normal(0, 0.1, (500, 4))
    stats = np.concatenate([usual, [[3, 0, 0, 0], [0, -2, 0, 2]]])
    scores = quality_rules.forest_scores(stats, quality_rules.grow_forest(stats, 200, 256, 1), 256)
    assert scores[-2:].min() > np.sort(scores[:-2])[-10]
    same = np.zeros((50, 4))
    assert len(set(quality_rules.forest_scores(same, quality_rules.grow_forest(same, 10, 16, 1), 16))) == 1
    assert quality_rules.grow_forest(np.empty((0, 4)), 10, 16, 1) == []


def test_threshold_respects_the_limit():
    histogram = [(10, 1, 980), (60, 1, 15), (70, 1, 5), (60, 0, 50), (70, 0, 40), (10, 0, 10)]
    assert quality_rules.verdict_bin(histogram, 100, 0.02) in range(11, 61)
    assert quality_rules.verdict_bin(histogram, 100, 0.01) in range(61, 71)
    assert quality_rules.verdict_bin([(5, 1, 9)], 100, 0.5) == 101


def test_repeated_windows():
    hashes = WordHashes().array
    assert quality_rules.repeated_words(hashes([b"a"] * 8)) == 0
    assert quality_rules.repeated_words(hashes([b"a"] * 9)) == 9
    assert quality_rules.repeated_words(hashes([b"%d" % (i % 8) for i in range(16)])) == 16
