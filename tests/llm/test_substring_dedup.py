import random

from llm_data import SF, documents, llm, nothing, odd, odd_rows  # noqa: F401
import xxhash

from tillbook.llm import substring_dedup

SPACE = " \t\n\x0b\x0c\r"


def sentences(text):
    """(start, end, words) of each sentence; a sentence reaches to the first word of the next."""
    words, at = [], None
    for i, ch in enumerate((text or "") + " "):
        if ch in SPACE:
            if at is not None:
                words.append((at, i))
            at = None
        elif at is None:
            at = i
    out, part = [], []
    for k, (a, b) in enumerate(words):
        word = text[a:b].encode().lower()
        part.append((a, word))
        gap = text[b : words[k + 1][0]] if k + 1 < len(words) else "\n"
        if "\n" in gap or word[-1:] in b".!?,;:" or xxhash.xxh64_intdigest(word) >> 60 == 0:
            out.append(part)
            part = []
    starts = [p[0][0] for p in out] + [len(text or "")]
    if out:
        starts[0] = 0
    return [(starts[i], starts[i + 1], [w for _, w in p]) for i, p in enumerate(out)]


def runs_of(parts, least=3, least_words=12):
    out = []
    for i in range(len(parts)):
        words, j = [], i
        while j < len(parts) and (j - i < least or len(words) < least_words):
            words += parts[j][2]
            j += 1
        if j - i >= least and len(words) >= least_words:
            out.append((i, j, tuple(words)))
    return out


def brute(rows):
    owner = {}
    for doc, text in rows:
        if doc is not None:
            for _, _, run in runs_of(sentences(text)):
                owner[run] = min(owner.get(run, doc), doc)
    out = []
    for doc, text in rows:
        parts, gone, seen = sentences(text), set(), set()
        for i, j, run in runs_of(parts):
            if run in seen or (doc is not None and owner[run] != doc):
                gone.update(range(i, j))
            seen.add(run)
        kept = "".join(text[a:b] for k, (a, b, _) in enumerate(parts) if k not in gone) if gone else text
        out.append((doc, kept, len(parts), len(gone)))
    return sorted(out, key=repr)


def test_documents_equal_brute_force(llm, documents):
    got = substring_dedup.without_repeats(llm.read.parquet(f"{SF}/documents.parquet"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(documents)


def test_odd_rows(odd, odd_rows, nothing):
    got = substring_dedup.without_repeats(odd)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(odd_rows)
    assert substring_dedup.without_repeats(nothing).collect() == []


def test_planted_passages_stand_once(llm):
    rng = random.Random(2)
    words = [f"u{i}" for i in range(5000)]

    def some(n):
        return [rng.choice(words) + rng.choice(["", "", "", "", ",", "."]) for _ in range(n)]

    passages = [some(60) for _ in range(6)]
    rows = [(i, " ".join(some(40) + passages[i % 6] + some(40))) for i in range(60)]
    clean = [(1000 + i, " ".join(some(120))) for i in range(20)]
    out = {r.doc_id: r for r in substring_dedup.without_repeats(llm.createDataFrame(rows + clean, "doc_id long, text string")).collect()}
    for doc, text in rows:
        middle = " ".join(passages[doc % 6][25:35])
        assert (middle in out[doc].text) == (doc < 6)
        assert text[:100] == out[doc].text[:100]
    assert all(out[d].text == t for d, t in clean)


def test_no_word_is_lost_elsewhere(llm, documents):
    got = {r.doc_id: r.text for r in substring_dedup.without_repeats(llm.read.parquet(f"{SF}/documents.parquet")).collect()}
    runs = substring_dedup.Runs()
    assert all(got[d] == t for d, t in documents if not len(runs.of(t)[1]))
