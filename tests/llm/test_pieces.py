"""SentencePiece models on the tokenizers library against sentencepiece itself."""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest

sentencepiece = pytest.importorskip("sentencepiece")

from wagegrid.llm import pieces  # noqa: E402

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  a", "a  b \n c ", "x" * 3000, "a▁b ▁c d▁ e", "<s> hi </s> <unk>",
       "é̈ 日本語 😀 \x00 \t", " lead", "trail ", "▁", "<0x41> b", "a　b c", "word " * 900]


def test_parity_and_round_trip():
    codec, judge = pieces.Codec(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert codec.by_word
    ids, same = codec.encode(ODD)
    assert [x.tolist() for x in ids] == judge.encode(ODD) and all(same)
    assert codec.decode(ids) == judge.decode(judge.encode(ODD))


def test_a_wrong_merge_is_noticed_and_corrected():
    codec, judge = pieces.Codec(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    with open(PATH, "rb") as file:
        model = pieces.parse_model(file.read())
    model["pieces"] = [dict(p) for p in model["pieces"]]
    for p in model["pieces"]:
        p["score"] = -p["score"]
    codec.library = pieces.rebuild(model)
    texts = ["reconsideration ononedth unbelievably thinninghe administrations", "a"]
    ids, same = codec.encode(texts)
    assert [x.tolist() for x in ids] == judge.encode(texts) and not same[0]


def _field(number, value):
    if isinstance(value, float):
        return bytes([number << 3 | 5]) + struct.pack("<f", value)
    if isinstance(value, int):
        key, out = number << 3, b""
        for part in (key, value):
            while part > 127:
                out += bytes([part & 127 | 128])
                part >>= 7
            out += bytes([part])
        return out
    out, size = b"", len(value)
    for part in (number << 3 | 2, size):
        while part > 127:
            out += bytes([part & 127 | 128])
            part >>= 7
        out += bytes([part])
    return out + value


def _unigram(squeeze: int, fallback: int = 1) -> bytes:
    texts = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    texts += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] if fallback else []
    texts += [(t, s, 1) for t, s in [
        ("▁", -2.0), ("▁th", -3.0), ("▁the", -3.1), ("e", -4.0), ("t", -4.2), ("h", -4.1), ("ing", -3.5),
        ("in", -3.9), ("g", -5.0), ("i", -4.4), ("n", -4.3), ("▁in", -3.3), ("a", -4.0), ("é", -6.0)]]
    body = b"".join(_field(1, _field(1, t.encode()) + _field(2, s) + _field(3, k)) for t, s, k in texts)
    return (body + _field(2, _field(3, 1) + _field(35, fallback) + _field(40, 0))
            + _field(3, _field(1, b"identity") + _field(3, 1) + _field(4, squeeze)))


@pytest.mark.parametrize("squeeze", [0, 1])
@pytest.mark.parametrize("fallback", [0, 1])
def test_unigram_scores_and_byte_fallback(tmp_path, squeeze, fallback):
    path = tmp_path / "unigram.model"
    path.write_bytes(_unigram(squeeze, fallback))
    codec, judge = pieces.Codec(str(path)), sentencepiece.SentencePieceProcessor(model_file=str(path))
    texts = ["the thing", "  in the  night ", "", "ته 😀 é", "thinging the"]
    ids, same = codec.encode(texts)
    assert [x.tolist() for x in ids] == judge.encode(texts)
    assert all(s for s, t in zip(same, texts) if t.isascii())


def test_odd_rows(odd_docs, no_docs):
    judge = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = pieces.decode(pieces.encode(odd_docs.withColumnRenamed("g", "ids"), PATH), PATH).collect()
    want = sorted((r.doc_id or -1, r.text or "") for r in odd_docs.collect())
    assert sorted((r.doc_id or -1, r.decoded) for r in rows) == [
        (i, judge.decode(judge.encode(t))) for i, t in want]
    by = {(r.doc_id or -1, r.n_bytes): r for r in rows}
    for i, t in want:
        r = by[i, len(t.encode())]
        assert np.frombuffer(r.ids, "<u4").tolist() == judge.encode(t) and r.parity
    assert pieces.decode(pieces.encode(no_docs, PATH), PATH).collect() == []


def test_query_whole_table(llm, sf, queries):
    judge = sentencepiece.SentencePieceProcessor(model_file=PATH)
    got = {r.doc_id: r for r in queries["op5_sentencepiece"](llm, sf).collect()}
    for d in llm.read.parquet(f"{sf}/documents.parquet").collect():
        ids, r = judge.encode(d.text or ""), got[d.doc_id]
        assert (r.n_tokens, r.parity) == (len(ids), True)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert r.decoded_sha256 == hashlib.sha256(judge.decode(ids).encode()).hexdigest()
