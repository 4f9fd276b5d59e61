import os
import re
import sys

import pytest
from llm_data import SF, documents, llm, nothing, odd, odd_rows  # noqa: F401

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import __spark_entry__  # noqa: E402
import corpus_pipeline  # noqa: E402
from test_bpe import digests, reference  # noqa: E402, F401
from test_decontaminate import brute_matches  # noqa: E402
from test_pii import brute as base_spans  # noqa: E402
from test_simhash import brute_components  # noqa: E402
from tillbook.llm import decontaminate, queries  # noqa: E402


def test_stages_in_order_keep_the_columns(llm, documents, reference):  # noqa: F811
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = docs = stage(llm, docs, SF).cache()
        if name != "tokens":
            assert docs.columns == columns, name
    kept = [tuple(r) for r in seen["quality"].select("doc_id", "text").collect()]
    assert 0 < len(kept) < len(documents)

    # near-duplicates: exactly the smallest id of each brute-force component stays
    assert {r.doc_id for r in seen["near_dedup"].collect()} == {least for _, _, least in brute_components(kept)}

    # decontamination: exactly the documents without a match stay
    items = [tuple(r) for r in llm.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    shared = decontaminate.PlainWords()
    known = {h for _, t in items for h in shared.of(t).tolist()}
    before = {r.doc_id: r.text for r in seen["near_dedup"].collect()}
    after = {r.doc_id for r in seen["decontamination"].collect()}
    assert {d for d, t in before.items() if any(x in t for _, x in items)}.isdisjoint(after)
    for d in set(before) - after:
        likely = [i for i in items if len(set(shared.of(i[1]).tolist()) & set(shared.of(before[d]).tolist()) & known) > 4]
        assert brute_matches(before[d], likely, 0.8)

    # personal data: no base span is left and nothing else changes
    for r in seen["personal_data"].collect():
        assert not [s for s in base_spans(r.text)] and (r.text == before[r.doc_id]) == (not base_spans(before[r.doc_id]))
        assert re.sub("<[A-Z]+>", "", r.text)[:20] == before[r.doc_id][:20] or base_spans(before[r.doc_id])

    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in seen["tokens"].collect())
    assert got == sorted((r.doc_id, *digests(reference, r.text)) for r in seen["personal_data"].collect())
    assert got == sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(llm, SF).collect())


def test_odd_rows_pass_every_stage(llm, odd, nothing):
    for docs in (odd, nothing):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(llm, docs, SF)
        docs.collect()


@pytest.mark.parametrize("name", queries.queries())
def test_query_is_registered_and_runs(llm, name):
    assert name in __spark_entry__.queries()
    out = __spark_entry__.queries()[name](llm, SF)
    assert out.count() > 0


def test_every_operator_has_its_query():
    numbers = {int(re.match(r"op(\d+)_", n)[1]) for n in queries.queries()}
    assert numbers == set(range(1, 14)) and "pipeline" in __spark_entry__.queries()
