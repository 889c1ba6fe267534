"""The pipeline's stages and result against their parts and brute force."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest

tokenizers = pytest.importorskip("tokenizers")

import corpus_pipeline  # noqa: E402
from tests.llm.test_dedup import Sets, plain_cut, plain_fingerprint  # noqa: E402
from wagegrid.llm.shared import store  # noqa: E402


def _clean(cut: bytes) -> str:
    text = cut.decode(errors="replace")
    return text.replace("�", "") if text.encode() != cut else text


def _expected(rows):
    """Rows after the two deduplicating stages, by brute force."""
    fps = {i: plain_fingerprint(t) for i, t in rows.items()}
    sets, ids = Sets(fps), sorted(fps)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                sets.join(a, b)
    kept = [i for i in ids if sets.root(i) == i]
    cut = plain_cut([(i, rows[i].encode()) for i in kept])
    return {i: _clean(body) for i, _, _, _, body in cut}


def test_run_equals_brute_force(llm, sf):
    docs = llm.read.parquet(f"{sf}/documents.parquet")
    spoken = corpus_pipeline.language_id(llm, docs, sf)
    rows = {r.doc_id: r.text for r in spoken.collect()}
    want = _expected(rows)
    lib = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = {i: len(lib.encode(t, add_special_tokens=False).ids) + 1 for i, t in want.items()}
    got: dict[int, int] = {}
    for r in corpus_pipeline.run(llm, sf).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == tokens


def test_every_stage_on_odd_rows(llm, sf, odd_docs, no_docs):
    columns = list(corpus_pipeline.COLUMNS)
    for docs in (odd_docs, no_docs, odd_docs.unionByName(odd_docs)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(llm, docs, sf)
            assert out.columns == columns
            out.collect()
        corpus_pipeline.STAGES[-1][1](llm, docs, sf).collect()


def test_near_duplicate_stage_keeps_one_of_each_group(llm, sf, odd_docs):
    out = corpus_pipeline.near_duplicates(llm, odd_docs.unionByName(odd_docs), sf).collect()
    ids = [r.doc_id for r in out if r.doc_id is not None]
    assert len(ids) == len(set(ids)) and {1, 2, 4} <= set(ids) and not {3, 5, 10} & set(ids)


def test_near_duplicate_stage_decides_by_row_where_ids_repeat(llm, sf):
    words = ["alpha beta gamma delta epsilon zeta", "one two three four five six seven",
             "rain falls on the old stone bridge today", "Rain falls on the old stone bridge today"]
    rows = [(1, words[0]), (5, words[0]), (5, words[1]), (7, words[2]), (7, words[3]), (7, words[1]),
            (8, words[0]), (5, words[1]), (None, words[0]), (9, "nine green bottles hang on the wall")]
    docs = llm.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows],
                               "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for parts in (1, 5):
        out = corpus_pipeline.near_duplicates(llm, docs.repartition(parts), sf).collect()
        assert sorted(((r.doc_id or 0), r.text) for r in out) == [
            (0, words[0]), (1, words[0]), (5, words[1]), (7, words[3]), (9, rows[9][1])]


def test_language_stage_keeps_clean_documents(llm):
    docs = llm.read.parquet("/root/testdata/sf0.01/documents.parquet")
    extra = llm.createDataFrame([(9001, "qzxv jjkw xqzp vvkz wqxj " * 20, None, "s", 1),
                                 (9002, "12 34 !!", None, "s", 1)], docs.schema)
    out = {r.doc_id for r in corpus_pipeline.language_id(
        llm, docs.unionByName(extra), "/root/testdata/sf0.01").collect()}
    assert out == {r.doc_id for r in docs.select("doc_id").collect()}


def test_cut_characters_leave_valid_text(llm, sf):
    body = "é" * 60
    rows = [(1, "a" + body, None, None, 0), (2, "b" + body + "ü end", None, None, 0)]
    docs = store(llm.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"),
                 "t")
    out = {r.doc_id: r for r in corpus_pipeline.repeated_passages(llm, docs, sf).collect()}
    assert out[2].text.encode().decode() == out[2].text and out[2].n_chars == len(out[2].text)
    assert np.char.find(out[2].text, "�") < 0
