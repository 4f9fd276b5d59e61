import random

import xxhash
from llm_data import SF, documents, llm, nothing, odd, odd_rows  # noqa: F401

from tillbook.llm import simhash
from tillbook.llm.bktree import BKTree
from tillbook.llm.components import components

ALL = 0xFFFFFFFFFFFFFFFF


def brute_fingerprint(text, k=3):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [b" ".join(w)] if w else []
    h = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def joined(nodes, links):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    return {n: top(n) for n in nodes}


def brute_components(rows, radius=2):
    fps = {i: brute_fingerprint(t) for i, (_, t) in enumerate(rows)}
    keys = list(fps)
    links = [(a, b) for a in keys for b in keys if a < b and (fps[a] ^ fps[b]).bit_count() <= radius]
    tops = joined(keys, links)
    least = {}
    for i, top in tops.items():
        if rows[i][0] is not None:
            least[top] = min(least.get(top, rows[i][0]), rows[i][0])
    return sorted(((rows[i][0], f"{fps[i]:016x}", least.get(tops[i])) for i in keys), key=repr)


def test_components_equal_brute_force(llm, documents):
    got = simhash.fingerprint_components(llm.read.parquet(f"{SF}/documents.parquet")).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_components(documents)


def test_odd_rows(odd, odd_rows, nothing):
    got = simhash.fingerprint_components(odd).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_components(odd_rows)
    assert simhash.fingerprint_components(nothing).collect() == []


def test_one_document_of_each_component_stays(llm, documents, odd, odd_rows, nothing):
    least = {least for _, _, least in brute_components(documents)}
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    left = simhash.drop_linked(docs)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == least and len(least) < len(documents)
    keepers = {d for d, _, top in brute_components(odd_rows) if d is not None and d == top}
    want = [d for d, _ in odd_rows if d is None or d in keepers]
    assert sorted((r.doc_id for r in simhash.drop_linked(odd).collect()), key=repr) == sorted(want, key=repr)
    assert simhash.drop_linked(nothing).collect() == []


def test_links_of_close_fingerprints_and_split_shards(llm):
    rng = random.Random(5)
    fps = set()
    for _ in range(60):
        centre = rng.getrandbits(64)
        for _ in range(6):
            other = centre
            for bit in rng.sample(range(64), rng.randrange(0, 4)):
                other ^= 1 << bit
            fps.add(other)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    expected = {(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 2}
    distinct = llm.createDataFrame([(f,) for f in signed], "fp long")
    for shard_rows in (20_000, 2):
        got = [(r[0] & ALL, r[1] & ALL) for r in simhash.fingerprint_links(distinct, 2, shard_rows).collect()]
        assert sorted(got) == sorted(expected)


def test_bk_tree_finds_what_a_scan_finds():
    rng = random.Random(6)
    fps = [rng.getrandbits(16) for _ in range(500)]
    tree = BKTree(fps)
    for fp in fps[:50]:
        for radius in (0, 2, 5):
            assert sorted(tree.within(fp, radius)) == sorted({f for f in fps if (f ^ fp).bit_count() <= radius})
    assert BKTree().within(1, 3) == []


def test_connected_components_of_paths_stars_and_loops(llm):
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (201, 200), (200, 201)]
    got = {r[0]: r[1] for r in components(llm.createDataFrame(links, "u long, v long")).collect()}
    nodes = {n for a, b in links for n in (a, b)}
    assert got == joined(nodes, links)
    assert components(llm.createDataFrame([], "u long, v long")).collect() == []


def shingles(text, k=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute_groups(rows, similarity=0.8):
    sets = {i: shingles(t) for i, (_, t) in enumerate(rows)}
    links = []
    for a in sets:
        for b in sets:
            if a < b:
                x, y = sets[a], sets[b]
                if (rows[a][1] or "").encode().lower().split() == (rows[b][1] or "").encode().lower().split():
                    links.append((a, b))
                elif x and y and len(x & y) >= similarity * len(x | y):
                    links.append((a, b))
    return joined(list(sets), links)


def near_copies():
    """Groups of texts at different similarities, many of them in one large group, and texts that share a passage."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(4000)]
    rows = []
    for g in range(12):
        base = [rng.choice(words) for _ in range(120)]
        for _ in range(40 if g == 0 else 4):
            text = list(base)
            for _ in range(rng.randrange(0, 4)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((len(rows), " ".join(text)))
    passage = [rng.choice(words) for _ in range(60)]
    for _ in range(20):
        rows.append((len(rows), " ".join(passage + [rng.choice(words) for _ in range(90)])))
    rows += [(len(rows) + i, t) for i, t in enumerate(["", None, "few words", "Few  Words", "other words"])]
    return rows


def test_near_duplicate_groups_equal_brute_force(llm):
    rows = near_copies()
    tops = brute_groups(rows)
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for shard_rows in (1000, 7):
        got = {r[0]: r[1] for r in simhash.near_duplicate_groups(docs, shard_rows=shard_rows).collect()}
        assert got == tops
    left = {r.doc_id for r in simhash.drop_near_duplicates(docs).collect()}
    assert left == set(tops.values())


def test_dedup_keeps_rows_without_id_and_all_columns(odd, odd_rows, nothing):
    left = simhash.drop_near_duplicates(odd)
    assert left.columns == odd.columns
    ids = [r.doc_id for r in left.collect()]
    # empty texts are one group kept by 1; rows of one id stay together; null ids stay
    assert sorted(ids, key=repr) == sorted([None, None, 1, 4, 5, 5, 6, 6, 7, 8, 9], key=repr)
    assert simhash.drop_near_duplicates(nothing).collect() == []


def repeated_lines():
    """Pairs of texts of 150 distinct words, one with some of its lines ten times, that share 85% to all of their shingles."""
    rng = random.Random(11)
    rows = []
    for g in range(60):
        base = [f"r{g}x{i}" for i in range(150)]
        other = list(base)
        for _ in range(g % 3):
            other[rng.randrange(len(other))] = f"o{len(rows)}"
        line = " ".join(other[20:32])
        text = " ".join(other)
        rows.append((2 * g, " ".join(base)))
        rows.append((2 * g + 1, text.replace(line, "\n".join([line] * 10))))
    return rows


def test_near_copies_with_repeated_lines_are_grouped(llm):
    rows = repeated_lines()
    tops = brute_groups(rows)
    assert len(set(tops.values())) < len(rows)
    got = {r[0]: r[1] for r in simhash.near_duplicate_groups(llm.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == tops


def test_groups_of_a_hot_shard_are_bounded_and_meet_every_pair_once(llm):
    from pyspark.sql import functions as F

    members = llm.range(3000).select(F.lit(1).alias("key"), F.col("id").alias("item"))
    rows = simhash.in_trees(members, ["key"], "item", 200).select("tree", "own", "item").collect()
    held = {}
    for r in rows:
        held.setdefault(r.tree, ([], []))[r.own].append(r.item)
    assert len(held) == 15 * 16 // 2 and max(len(a) + len(b) for a, b in held.values()) < 2 * 200 * 1.5
    met = []
    for tree, (visitors, own) in held.items():
        assert len(simhash.seekers(tree, [True] * len(own) + [False] * len(visitors))) == (len(visitors) or len(own))
        met += [(min(a, b), max(a, b)) for a in visitors for b in own] if visitors else [(a, b) for a in own for b in own if a < b]
    assert len(met) == len(set(met)) == 3000 * 2999 // 2
