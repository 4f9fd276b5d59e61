import hashlib
import random
import re

from llm_data import SF, documents, llm, nothing, odd, odd_rows  # noqa: F401

from tillbook.llm import pii

# The patterns as the contract states them.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if valid(k, m[0])]


def expected(rows):
    out = []
    for doc, text in rows:
        found = brute(text)
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        out.append((doc, *[sum(f[0] == k for f in found) for k in PLAIN], hashlib.sha256(base.encode()).hexdigest(), base))
    return sorted(out, key=repr)


def base_of(df):
    out = []
    for r in df.collect():
        spans = ",".join(s for s in (r.spans or "").split(",") if s and not s.startswith("id:"))
        out.append((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, spans))
    return sorted(out, key=repr)


def test_base_spans_of_the_documents(llm, documents):
    got = base_of(pii.personal_data(llm.read.parquet(f"{SF}/documents.parquet")))
    assert got == expected(documents)
    assert any(r[6] for r in got)


def test_base_spans_of_random_and_hostile_texts(llm):
    rng = random.Random(8)
    bits = ["a@b.c", "x.y@z-1.org", "+x@y.org", "1.2.3.4", "256.1.1.1", "001.02.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1111", "5", "+49 (170) 123-4567", "+1", "é", "漢", "😀", " ", ".", "-", "@", "%", "\n", "4222222222222", "_", "+12345678901234567"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 25))) for _ in range(1500)]
    texts += ["1" * 20_000, "1 " * 9_000, "a" * 30_000 + "@b.c", "a@" + "b." * 9_000 + "c", "+1" + "." * 20_000, "1." * 9_000, "a@b.c " * 900]
    rows = list(enumerate(texts))
    got = base_of(pii.personal_data(llm.createDataFrame(rows, "doc_id long, text string").repartition(4)))
    for g, e in zip(got, expected(rows), strict=True):
        assert g == e, texts[g[0]][:80]


def context_rows():
    rows = [(i, f"please write to office mail: clerk{i}@shop.example thanks") for i in range(12)]
    rows += [(20 + i, f"the staff badge no +4930{1000000 + i} is new") for i in range(8)]
    rows += [(40, "please write to office mail: clerk99(at)shop-4711 thanks"), (41, "the staff badge no 77-1234-99 is new")]
    rows += [(50 + i, f"an order number {100000 + i} and the room {i}") for i in range(30)]
    return rows


def test_context_discovers_unseen_identifiers_only(llm):
    out = {r.doc_id: r for r in pii.personal_data(llm.createDataFrame(context_rows(), "doc_id long, text string")).collect()}
    found = {d: [s for s in r.spans.split(",") if s.startswith("id:")] for d, r in out.items()}
    text = dict(context_rows())
    assert {d for d, s in found.items() if s} == {40, 41}
    for d, word in ((40, "clerk99(at)shop-4711"), (41, "77-1234-99")):
        (span,) = found[d]
        _, a, b = span.split(":")
        assert text[d][int(a) : int(b)] == word


def brute_scores(edges, rounds, least_score):
    """{pattern: (score, believed instances)} of {(pattern, instance): seed} by plain loops."""
    belief = {}
    for (_, i), seed in edges.items():
        belief[i] = max(belief.get(i, 0.0), float(seed))
    known = {i for i, b in belief.items() if b == 1.0}
    for n in range(rounds):
        by_pattern = {}
        for p, i in edges:
            by_pattern.setdefault(p, []).append(belief[i])
        scores = {p: (sum(b) / (len(b) + 1), sum(x >= least_score for x in b)) for p, b in by_pattern.items()}
        if n + 1 < rounds:
            doubt = {}
            for p, i in edges:
                doubt[i] = doubt.get(i, 1.0) * (1 - min(scores[p][0], 0.999999))
            belief = {i: 1.0 if i in known else 1 - d for i, d in doubt.items()}
    return scores


def test_graph_scores_equal_brute_force(llm):
    rng = random.Random(3)
    edges = {(f"p{rng.randrange(12)}", f"i{rng.randrange(60)}"): rng.random() < 0.3 for _ in range(200)}
    df = llm.createDataFrame([(*k, v) for k, v in edges.items()], "pattern string, instance string, seed boolean")
    got = {r.pattern: (round(r.score, 9), r.seeds) for r in pii.pattern_scores(df, 4, 0.8).collect()}
    assert got == {p: (round(a, 9), b) for p, (a, b) in brute_scores(edges, 4, 0.8).items()}


def test_found_identifiers_speak_for_further_patterns(llm):
    """12 ids stand right of a pattern of many addresses, and with 3 unseen ids right of a second pattern."""
    rows = [(i, f"write to office mail: clerk{i}@shop.example now") for i in range(60)]
    rows += [(100 + i, f"write to office mail: A-77{1000 + i} now") for i in range(12)]
    rows += [(200 + i, f"member card code A-77{1000 + i} is valid") for i in range(12)]
    rows += [(300 + i, f"member card code B-99{2000 + i} is valid") for i in range(3)]
    rows += [(400 + i, f"order number {100000 + i} and room {i}") for i in range(30)]
    out = {r.doc_id: r.n_id for r in pii.personal_data(llm.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d for d, n in out.items() if n} == {*range(100, 112), *range(200, 212), 300, 301, 302}


def test_redaction(llm):
    rows = [(1, "Mail a@b.org, ask 10.0.0.1 or +49 170 1234567."), (2, None), (3, "nothing"), (4, "4111 1111 1111 1111"), (None, "é a@b.org")]
    docs = llm.createDataFrame(rows + [(60 + i, t) for i, t in context_rows()[:12]] + [(40, context_rows()[20][1])], "doc_id long, text string")
    out = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert out[2] is None and out[3] == "nothing" and out[4] == "<CARD>" and out[None] == "é <EMAIL>"
    assert out[40].endswith("office mail: <ID> thanks")
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.text for r in pii.redact(docs).collect()}[1] == "Mail <EMAIL>, ask <IP> or <PHONE>."


def test_no_python_in_the_plan(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    for df in (pii.personal_data(docs), pii.redact(docs), pii.findings(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not [w for w in ("Python", "Pandas", "Arrow", "ExistingRDD") if w in plan]


def test_odd_rows(odd, odd_rows, nothing):
    assert base_of(pii.personal_data(odd)) == expected(odd_rows)
    same = pii.redact(odd)
    assert same.columns == odd.columns
    assert sorted((tuple(r) for r in same.collect()), key=repr) == sorted((tuple(r) for r in odd.collect()), key=repr)
    assert pii.personal_data(nothing).collect() == [] and pii.redact(nothing).collect() == []
