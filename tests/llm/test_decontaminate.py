import random

import numpy as np
from llm_data import SF, documents, llm, nothing, odd, odd_rows  # noqa: F401

from tillbook.llm import decontaminate
from tillbook.llm.decontaminate import Items, PlainWords


def brute_matches(text, items, similarity):
    """Best weighted Jaccard similarity over every window of item size."""
    plain = PlainWords()
    hashes = plain.of(text).tolist()
    found = {}
    for item, own in items:
        words = plain.of(own).tolist()
        if not words:
            continue
        k = min(5, len(words))

        def shingles(w, k=k):
            return [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]

        mine = shingles(words)
        best = 0.0
        for at in range(len(hashes) - len(words) + 1):
            other = shingles(hashes[at : at + len(words)])
            kinds = set(mine) | set(other)
            low = sum(min(mine.count(s), other.count(s)) for s in kinds)
            best = max(best, low / sum(max(mine.count(s), other.count(s)) for s in kinds))
        if best >= similarity - 1e-12:
            found[item] = round(best, 9)
    return found


def cases():
    rng = random.Random(4)
    words = [f"v{i}" for i in range(300)]

    def some(n):
        return [rng.choice(words) for _ in range(n)]

    items = [(i, some(rng.choice([3, 6, 20, 45, 80]))) for i in range(25)] + [(90, ["one"]), (91, []), (92, ["again"] * 12)]
    texts = []
    for i, item in items:
        changed = list(item)
        for _ in range(len(item) // 40):
            changed[rng.randrange(len(item))] = rng.choice(words)
        texts.append(" ".join(some(30) + item + some(30)))
        texts.append("\n".join(w.upper() + "," for w in some(5) + changed + some(9)))
        texts.append(" ".join(item[: len(item) // 2] + some(40)))
    texts += ["", " ".join(some(400)), "again " * 40]
    return [(i, " ".join(w)) for i, w in items], texts


def test_search_equals_brute_force():
    items, texts = cases()
    plain = PlainWords()
    index = Items([(i, plain.of(t)) for i, t in items])
    for text in texts:
        got = {i: round(v[0], 9) for i, v in index.matches(plain.of(text), 0.8).items()}
        assert got == brute_matches(text, items, 0.8), text[:60]


def test_blocks_of_items_and_filter(llm):
    items, texts = cases()
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    table = llm.createDataFrame(items, "item_id long, text string")
    whole = sorted(tuple(r) for r in decontaminate.contamination(docs, table).collect())
    parts = sorted(tuple(r) for r in decontaminate.contamination(docs, table, block_words=100).collect())
    assert whole == parts and whole
    clean = {r.doc_id for r in decontaminate.drop_contaminated(docs, table, block_words=100).collect()}
    assert clean == set(range(len(texts))) - {r[0] for r in whole}


def test_planted_passages_are_found(llm, documents):
    docs, items = (llm.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    texts = [tuple(r) for r in items.select("item_id", "text").collect()]
    planted = {(d, i) for d, t in documents for i, x in texts if x in t}
    found = {(r.doc_id, r.item_id) for r in decontaminate.contamination(docs, items).collect()}
    assert planted and planted <= found


def test_odd_rows(llm, odd, nothing):
    items = llm.createDataFrame([(1, "the same words in the same row twice over"), (2, None), (None, "x"), (3, "!!")], "item_id long, text string")
    found = [(r.doc_id, r.item_id) for r in decontaminate.contamination(odd, items).collect()]
    assert sorted(found) == [(5, 1), (5, 1)]
    clean = decontaminate.drop_contaminated(odd, items)
    assert clean.columns == odd.columns and clean.count() == odd.count() - 2
    assert decontaminate.contamination(nothing, items).collect() == []
    assert decontaminate.contamination(odd, items.limit(0)).collect() == []
    assert decontaminate.drop_contaminated(odd, items.limit(0)).count() == odd.count()


def test_window_fingerprints_are_those_of_their_shingles():
    values = np.random.default_rng(1).integers(0, 2**63, 40, dtype=np.uint64)
    starts, widths = np.array([0, 3, 30]), np.array([7, 20, 10])
    for fp, s, w in zip(decontaminate.window_fingerprints(values, starts, widths), starts, widths, strict=True):
        part = [int(v) for v in values[s : s + w]]
        assert int(fp) == sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in part) > w)


def brute_short(text, items, similarity):
    """Best weighted Jaccard similarity where a text shorter than the item is the one window."""
    plain = PlainWords()
    found = {}
    for item, own in items:
        if len(plain.of(text)) >= len(plain.of(own)):
            found |= brute_matches(text, [(item, own)], similarity)
            continue
        a, b = (plain.of(t).tolist() for t in (text, own))
        k = min(5, len(b))
        x, y = ([tuple(w[i : i + k]) for i in range(len(w) - k + 1)] for w in (a, b))
        kinds = set(x) | set(y)
        value = sum(min(x.count(s), y.count(s)) for s in kinds) / sum(max(x.count(s), y.count(s)) for s in kinds)
        if value >= similarity - 1e-12:
            found[item] = round(value, 9)
    return found


def test_texts_shorter_than_items(llm):
    rng = random.Random(8)
    items = [(n, " ".join(f"s{rng.randrange(2000)}" for _ in range(n))) for n in (15, 16, 24, 59, 120)]
    texts = []
    for _, text in items:
        w = text.split()
        texts += [" ".join(w[a : len(w) - b]) for a in range(4) for b in range(4)] + [" ".join(w[: len(w) * 9 // 10]), " ".join(w[: len(w) * 3 // 4])]
    plain = PlainWords()
    for held in (items, items[3:], items[:1]):
        index = Items([(i, plain.of(t)) for i, t in held])
        for text in texts:
            assert {i: round(v[0], 9) for i, v in index.matches(plain.of(text), 0.8).items()} == brute_short(text, held, 0.8), text
    docs = llm.createDataFrame([(1, " ".join(items[3][1].split()[:-1])), (2, " ".join(items[0][1].split()[:-1]))], "doc_id long, text string")
    table = llm.createDataFrame(items, "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.contamination(docs, table).collect()) == [(1, 59), (2, 15)]
    assert decontaminate.drop_contaminated(docs, table).count() == 0


def test_items_without_an_id_are_dropped_too(llm):
    words = [f"n{i}" for i in range(30)]
    docs = llm.createDataFrame([(1, " ".join(words)), (2, " ".join(reversed(words)))], "doc_id long, text string")
    items = llm.createDataFrame([(None, " ".join(words)), (None, "other words of no document at all"), (5, "five")], "item_id long, text string")
    assert [r.doc_id for r in decontaminate.drop_contaminated(docs, items).collect()] == [2]
    assert decontaminate.contamination(docs, items).collect() == []


def test_pairs_at_the_boundary_are_all_found():
    rng = np.random.default_rng(6)
    lost = 0
    for n in range(3000):
        item = rng.integers(1, 2**63, 59, dtype=np.uint64)
        text = item.copy()
        text[:6] = rng.integers(1, 2**63, 6, dtype=np.uint64)  # 49 of 55 shingles are shared: similarity 49/61 = 0.803
        lost += not Items([(n, item)]).matches(text, 0.8)
    assert not lost


def test_repeated_shingles_far_apart_in_bits():
    rng = np.random.default_rng(7)
    for n in range(200):
        shared = rng.integers(1, 2**63, 84, dtype=np.uint64)
        item = np.concatenate([shared, np.full(14, rng.integers(1, 2**63, dtype=np.uint64))])
        text = np.concatenate([shared, np.full(14, item[-1] + np.uint64(1))])
        text[84:88] = item[84:88]  # the repeated shingle is 10 of 94 in one and gone in the other: 84 / 104 = 0.81
        found = Items([(n, item)]).matches(text, 0.8)
        assert found and abs(found[n][0] - 84 / 104) < 1e-9, n


def many_items(n, words=40):
    rng = random.Random(12)
    return [(i, " ".join(f"w{rng.randrange(20_000)}" for _ in range(words))) for i in range(n)]


def test_the_index_looks_at_a_small_part_of_all_pairs():

    plain, rng = decontaminate.PlainWords(), random.Random(13)
    index = decontaminate.Items([(i, plain.of(t)) for i, t in many_items(3000)]).indexes[0]
    fps = np.array([rng.getrandbits(64) for _ in range(200)], dtype=np.uint64)
    seen, most = 0, decontaminate.RADIUS // decontaminate.BLOCKS
    for first, size in index.bounds:
        mask = np.uint64((1 << size) - 1)
        a, b = (x >> np.uint64(first) & mask for x in (fps, index.fps))
        seen += int((np.bitwise_count(a[:, None] ^ b) <= most).sum())
    assert seen <= 0.2 * len(fps) * len(index.fps)
    near = index.near(fps, np.full(len(fps), index.widths[0]))
    distance = np.bitwise_count(fps[:, None] ^ index.fps)
    assert near.tolist() == np.flatnonzero(distance.reshape(-1) <= decontaminate.RADIUS).tolist()  # none is missed


def test_a_text_that_quotes_many_items():
    plain, items = decontaminate.PlainWords(), many_items(1000)
    index = decontaminate.Items([(i, plain.of(t)) for i, t in items])
    rng = random.Random(14)
    text = " ".join(" ".join([t, *(f"x{rng.random()}" for _ in range(7))]) for _, t in items[:800])
    found = index.matches(plain.of(text), 0.8)
    assert set(found) == set(range(800)) and all(v[0] == 1.0 for v in found.values())


def test_nothing_is_lost_beyond_the_radius():
    """With a radius of no bit, the pairs come from the postings alone and are the same."""
    plain, rng, items = decontaminate.PlainWords(), random.Random(15), many_items(60, 30)
    texts = []
    for _, t in items:
        words = t.split()
        for _ in range(rng.randrange(3)):
            words[rng.choice([0, 1, len(words) - 1])] = "other"
        at = rng.randrange(len(words))
        texts.append(" ".join([f"x{rng.random()}"] * 5 + words[:at] + words[at : at + 2] * rng.randrange(1, 3) + words[at + 2 :]))
    near = decontaminate.Items([(i, plain.of(t)) for i, t in items])
    far = decontaminate.Items([(i, plain.of(t)) for i, t in items], radius=0)
    found = [near.matches(plain.of(t), 0.8) for t in texts]
    assert found == [far.matches(plain.of(t), 0.8) for t in texts] and sum(map(len, found)) > 20
    for t, got in zip(texts, found, strict=True):
        assert set(got) == set(brute_matches(t, items, 0.8))


def quotes():
    """Items, and texts that quote each whole, with changes, with a part repeated, or by half."""
    plain, rng, items = decontaminate.PlainWords(), random.Random(16), many_items(40, 45)
    texts = []
    for n, (_, t) in enumerate(items):
        words = t.split()
        if n % 4 == 1:
            words[rng.randrange(45)] = "other"
        if n % 4 == 2:
            words[20:20] = words[19:20] * rng.randrange(1, 4)
        texts.append(" ".join([f"x{rng.random()}"] * 9 + (words if n % 4 != 3 else words[:22]) + [f"y{rng.random()}"] * 9))
    return [(i, plain.of(t)) for i, t in items], [plain.of(t) for t in texts]


def test_pairs_within_the_radius_come_from_the_fingerprints_alone(monkeypatch):
    items, texts = quotes()
    whole = [Items(items).matches(t, 0.8) for t in texts]
    assert sum(map(len, whole)) > 10
    monkeypatch.setattr(decontaminate.ItemIndex, "near", lambda self, fps, widths: np.empty(0, dtype=np.int64))
    without = [Items(items).matches(t, 0.8) for t in texts]
    assert all(not found for found, text in zip(without, whole, strict=True) if any(v[0] == 1.0 for v in text.values()))
    assert sum(map(len, without)) < sum(map(len, whole))
    assert [Items(items, radius=-1).matches(t, 0.8) for t in texts] == whole  # no pair is within -1 bits, so all are far


def test_postings_are_searched_where_fingerprints_find_nothing(monkeypatch):
    items, texts = quotes()
    index, asked = Items(items), []
    found = [bool(index.matches(t, 0.8)) for t in texts]
    far = decontaminate.ItemIndex.far
    monkeypatch.setattr(decontaminate.ItemIndex, "far", lambda self, *a: asked.append(1) or far(self, *a))
    assert [index.hold(t, 0.8) for t in texts] == found
    assert [index.hold(t, 0.8) for t in texts[::4]] == [True] * 10  # whole quotes
    before = len(asked)
    assert all(index.hold(t, 0.8) for t in texts[::4]) and len(asked) == before


def test_every_pair_is_near_or_far_and_none_both():
    items, texts = quotes()
    for radius in (-1, 0, 6, decontaminate.RADIUS):
        index = Items(items, radius=radius).indexes[0]
        for text in texts:
            shingles = decontaminate.runs(text, index.k)
            starts, sizes = index.windows(shingles, 0.8)
            spans = np.minimum(sizes, len(shingles))
            fps, held = decontaminate.window_fingerprints(shingles, starts, spans), index.occurrences(shingles)
            every = np.array([w * len(items) + i for w in range(len(starts)) for i in range(len(items)) if index.sizes[i] == sizes[w]], dtype=np.int64)
            distance = np.bitwise_count(fps[every // len(items)] ^ index.fps[every % len(items)])
            counts = [np.isin(shingles[starts[w] : starts[w] + spans[w]], index.items[i][1]).sum() for w, i in (divmod(p, len(items)) for p in every.tolist())]
            able = np.array(counts, dtype=np.int64) >= 0.8 * index.sizes[every % len(items)] - 1e-9
            near = index.able(held, index.near(fps, sizes), starts, spans, 0.8)
            assert near.tolist() == every[able & (distance <= radius)].tolist()
            assert index.far(held, fps, starts, spans, sizes, 0.8).tolist() == every[able & (distance > radius)].tolist()
