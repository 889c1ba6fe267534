"""Token counts, packing, chat formatting and language ID against brute force."""

from __future__ import annotations

import hashlib
import json
import zlib

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")
import public_tokenizers  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from wagegrid.llm import chat, langid  # noqa: E402
from wagegrid.llm.packing import assign, capacities, pack  # noqa: E402
from wagegrid.llm.tokens import Encoder, count_tokens, stable_spaces  # noqa: E402

FILES = ("byte_bpe_50k.json", "word_bpe_49k.json")
TRICKY = ["", " ", "  a", "a  b \n c ", "x" * 5000, "<|endoftext|>a <|endoftext|>",
          "a<|endoftext|> b's I'll  é̈ ̈z Σας ΟΔΟΣ ᄀ ᅡ x\x1cq \x1c r", "ab " * 9000,
          "\n".join(["www"] * 4000), "q" * 40000, "tab\there now\r\nnext  line"]


@pytest.mark.parametrize("name", FILES)
def test_ids_equal_the_library(name):
    path = public_tokenizers.path(name)
    enc, lib = Encoder(path), tokenizers.Tokenizer.from_file(path)
    want = [e.ids for e in lib.encode_batch(TRICKY, add_special_tokens=False)]
    flat, n = enc.encode(TRICKY)
    assert [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])] == want
    assert enc.counts(TRICKY).tolist() == [len(w) for w in want]


@pytest.mark.parametrize("name", FILES)
@pytest.mark.parametrize("chunk,overlap", [(300, 16), (1000, 64), (4096, 256)])
def test_resynchronised_chunks(name, chunk, overlap):
    path = public_tokenizers.path(name)
    enc, lib = Encoder(path), tokenizers.Tokenizer.from_file(path)
    for text in TRICKY:
        if len(text) > chunk:
            assert enc.count_long(text, chunk, overlap) == len(
                lib.encode(text, add_special_tokens=False).ids)


def test_stability_is_proven_not_assumed():
    for name, kind in zip(FILES, ("kept", "dropped")):
        with open(public_tokenizers.path(name), encoding="utf-8") as file:
            config = json.load(file)
        assert stable_spaces(config) == kind
        config["added_tokens"].append({"content": "a b", "lstrip": False, "rstrip": False})
        assert stable_spaces(config) is None


def test_long_texts_are_worked_on_in_parts(monkeypatch):
    from wagegrid.llm import tokens
    monkeypatch.setattr(tokens, "PART", 50)
    for name in FILES:
        path = public_tokenizers.path(name)
        enc, lib = Encoder(path), tokenizers.Tokenizer.from_file(path)
        texts = [*TRICKY, "one two\nthree  four five's " * 40]
        want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
        flat, n = enc.encode(texts)
        assert [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])] == want
        assert enc.counts(texts).tolist() == [len(w) for w in want]


def test_words_are_forgotten_but_ids_stay_right(monkeypatch):
    from wagegrid.llm import tokens
    monkeypatch.setattr(tokens, "MAX_WORDS", 5)
    path = public_tokenizers.path(FILES[0])
    enc, lib = Encoder(path), tokenizers.Tokenizer.from_file(path)
    for k in range(4):
        texts = [f"alpha beta{k} gamma{k} delta{k} one two three four{k}", "alpha beta0"]
        flat, n = enc.encode(texts)
        want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
        assert [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])] == want


@pytest.mark.parametrize("name", [*FILES, "piece_bpe_32k.model"])
def test_count_tokens_odd_rows(odd_docs, no_docs, name):
    path = public_tokenizers.path(name)
    got = count_tokens(odd_docs, path, chunk=5000, overlap=200).collect()
    rows = odd_docs.collect()
    if name.endswith(".model"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = lambda t: len(model.encode(t))
    else:
        lib = tokenizers.Tokenizer.from_file(path)
        size = lambda t: len(lib.encode(t, add_special_tokens=False).ids)
    want = sorted((r.doc_id or -1, len((r.text or "").encode()), size(r.text or ""))
                  for r in rows)
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)
    assert count_tokens(no_docs, path).collect() == []


def test_capacities_hold_exactly_all_tokens():
    for total in (1, 5, 2047, 2048, 2049, 5000, 12345):
        room = capacities(total, 2048)
        assert room.sum() == total
        assert all(r == 2048 or r & (r - 1) == 0 for r in room.tolist())


def test_assign_balances_cost():
    rng = np.random.RandomState(3)
    lengths = rng.randint(1, 6000, 300)
    rows = assign(lengths, 2048, 1.0, 1 / 4096)
    cost = {}
    for _, _, n, seq, _ in rows:
        cost[seq] = cost.get(seq, 0) + n + n * n / 4096
    # Sequences of whole pieces cost the most a sequence can; the others are close.
    mixed = [c for s, c in cost.items() if c < 2048 + 1024 and s < lengths.sum() // 2048]
    assert np.std(mixed) / np.mean(mixed) < 0.15


def _check_pieces(pieces, want):
    by_seq, by_doc = {}, {}
    for p in pieces:
        by_seq.setdefault(p.sequence_id, []).append((p.offset, p.length))
        by_doc.setdefault(p.doc_id, []).append(p)
    for parts in by_seq.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == 2048 or at & (at - 1) == 0 and at < 2048
    assert by_doc.keys() == want.keys()
    for doc, copies in want.items():
        ids = [p for p in by_doc[doc]]
        assert sum(p.length for p in ids) == sum(len(c) for c in copies)
        for p in ids:
            assert any(zlib.crc32(c[p.start:p.start + p.length].tobytes()) == zlib.crc32(p.ids)
                       and p.doc_tokens == len(c) for c in copies)


def test_pack_odd_rows(odd_docs, no_docs):
    path = public_tokenizers.path(FILES[0])
    lib = tokenizers.Tokenizer.from_file(path)
    want = {}
    for r in odd_docs.collect():
        ids = lib.encode(r.text or "", add_special_tokens=False).ids + [1]
        want.setdefault(r.doc_id, []).append(np.array(ids, "<u4"))
    _check_pieces(pack(odd_docs, path).collect(), want)
    _check_pieces(pack(odd_docs.repartition(5), path, batch_tokens=3000).collect(), want)
    assert pack(no_docs, path).collect() == []


def test_query_op1_and_op4_whole_table(llm, sf, queries):
    docs = llm.read.parquet(f"{sf}/documents.parquet").collect()
    lib = tokenizers.Tokenizer.from_file(public_tokenizers.path(FILES[0]))
    ids = {d.doc_id: np.array(lib.encode(d.text or "", add_special_tokens=False).ids + [1], "<u4")
           for d in docs}
    pieces = queries["op1_packing"](llm, sf).collect()
    assert {p.doc_id for p in pieces} == ids.keys()
    for p in pieces:
        assert zlib.crc32(ids[p.doc_id][p.start:p.start + p.length].tobytes()) == p.ids_crc32
    assert sum(p.length for p in pieces) == sum(map(len, ids.values()))
    lib = tokenizers.Tokenizer.from_file(public_tokenizers.path(FILES[1]))
    want = {d.doc_id: len(lib.encode(d.text or "", add_special_tokens=False).ids) for d in docs}
    assert {r.doc_id: r.n_tokens for r in queries["op4_token_counts"](llm, sf).collect()} == want


# -- chat ------------------------------------------------------------------------

PARTS = f"conv_id bigint, turn bigint, role string, parts array<{chat.PART}>, piece string, head int"


def _part(kind, text=None, ref=None, units=None):
    return (kind, text, ref, units)


def test_chat_parts_round_trip(llm):
    nasty = "\\l \\s <turn x></turn>\n<part image 0> \\### > end\\"
    rows = [(1, 0, "system", [_part("text", "be kind")], "p", 1),
            (1, 1, "user", [_part("text", nasty), _part("image", ref="a.png", units=64),
                            _part("text", "and"), _part("audio", ref="b.wav", units=3)], "p", 1),
            (1, 2, "assistant", [_part("text", nasty), _part("text", "é😀")], "p", 1),
            (1, 3, "user", [_part("document", ref="c.pdf", units=2), None], "p", 1),
            (1, 4, "assistant", None, None, None), (None, None, None, None, None, None),
            (2, 0, "we<turn>ird>", [_part("odd", ref="r")], "p", 1),
            (2, 0, "assistant", [], "p", 1), (2, 0, "assistant", [], "p", 1)]
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(
        llm.createDataFrame(rows, PARTS))).collect()}
    one = got[1]
    assert [t.role for t in one.turns] == ["system", "user", "assistant", "user", "assistant"]
    assert one.turns[1].text == nasty + "<part image 0>and<part audio 1>"
    assert one.turns[3].text == "<part document 2>" and one.turns[4].text == ""
    assert one.loss_texts == [nasty + "é😀", ""]
    for s, text in zip(one.loss_spans, one.loss_texts):
        raw = one.formatted[s.start:s.start + s.length]
        assert raw.replace("\\l", "<").replace("\\s", "\\") == text
        assert one.formatted[s.turn_start:s.start] == "<turn assistant>"
    assert [(a.position, a.kind, a.ref, a.tokens) for a in one.attachments] == [
        (0, "image", "a.png", 64), (1, "audio", "b.wav", 75), (2, "document", "c.pdf", 1200)]
    assert one.expanded_tokens == 64 + 75 + 1200
    assert [(t.role, t.text) for t in got[None].turns] == [("", "")]
    assert [t.role for t in got[2].turns] == ["assistant", "assistant", "we<turn>ird>"]
    assert chat.format_conversations(llm.createDataFrame([], PARTS)).collect() == []


def test_chat_with_very_long_texts(llm):
    long = "\\ <turn user></turn> é < " * 150_000
    rows = [(1, t, "assistant" if t % 2 else "user", long if t < 2 else f"{t} </turn>") for t in range(300)]
    turns = llm.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn(
        "parts", chat.text_part(F.col("text")))
    got = chat.read_back(chat.format_conversations(turns)).first()
    assert [(t.role, t.text) for t in got.turns] == [(r, t) for *_, r, t in rows]
    assert got.loss_texts == [t for *_, r, t in rows if r == "assistant"]
    assert len(got.formatted) > 2 * len(long) > 6_000_000


def test_chat_plan_is_native(llm, sf, queries):
    plan = queries["op9_chat_formatting"](llm, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert plan.split("== Physical Plan ==")[1].count("Exchange") == 1


def test_chat_query_brute_force(llm, sf, queries):
    said = {}
    for r in llm.read.parquet(f"{sf}/conversations.parquet").collect():
        said.setdefault(r.conv_id, []).append((r.turn, r.role or "", r.text or ""))
    said[-7] = [(0, "user", "\\### Assistant: </turn> ok"), (1, "assistant", "\\### Assistant: </turn> ok")]
    got = {r.conv_id: r for r in queries["op9_chat_formatting"](llm, sf).collect()}
    assert got.keys() == said.keys()
    for conv, turns in said.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        r = got[conv]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


# -- language ID -------------------------------------------------------------------

def _plain_kneser_ney(counts, alphabet_size):
    """Probability of the last character of a key tuple, by the textbook formula."""
    def prob(key):
        if not key:
            return 1.0 / alphabet_size
        c = counts[len(key)]
        ones = sum(1 for v in c.values() if v == 1)
        twos = sum(1 for v in c.values() if v == 2)
        cut = min(max(ones / max(ones + 2 * twos, 1), 0.1), 0.95)
        same = [v for k, v in c.items() if k[:-1] == key[:-1]]
        if not same:
            return prob(key[1:])
        return (max(c.get(key, 0) - cut, 0) / sum(same)
                + cut * len(same) / sum(same) * prob(key[1:]))
    return prob


def test_model_equals_plain_kneser_ney():
    texts = ["abra cadabra", "abba bab", "cab abra"]
    model = langid.train({"x": texts, "y": ["zyx zyz xyz", "zz yy"]})
    numbers = model.numbers()
    codes, begin, _ = langid._codes([t for i, t in enumerate(texts) if i % 4 or len(texts) < 4], numbers)
    pads = {b + k for b in begin.tolist() for k in range(langid.ORDER - 1)}
    counts = {langid.ORDER: {}}
    for i in range(len(codes)):
        if i not in pads:
            key = tuple(int(c) for c in codes[i - langid.ORDER + 1:i + 1])
            counts[langid.ORDER][key] = counts[langid.ORDER].get(key, 0) + 1
    for order in range(langid.ORDER - 1, 0, -1):
        counts[order] = {}
        for key in counts[order + 1]:
            counts[order][key[1:]] = counts[order].get(key[1:], 0) + 1
    prob = _plain_kneser_ney(counts, len(model.alphabet) + 2)
    asked = [tuple(model.numbers()[[ord(c) for c in gram]].tolist())
             for gram in ("abra", "bab ", "zabr", "zzzz", "cada", " xyz", "brac")]
    keys = np.array([sum(c << 16 * (3 - i) for i, c in enumerate(a)) for a in asked], np.uint64)
    got = np.exp(model.log_probs(keys)[:, model.langs.index("x")])
    assert np.allclose(got, [prob(a) for a in asked], rtol=1e-4)


def test_probabilities_sum_to_one():
    model = langid.train({"x": ["abra cadabra abba"] * 2, "y": ["zyx zyz"] * 2})
    v = len(model.alphabet) + 2
    for context in ((3, 2, 4), (0, 0, 0), (1, 1, 1), (5, 0, 2)):
        base = sum(c << 16 * (3 - i) for i, c in enumerate(context))
        keys = np.array([base | c for c in range(v)], np.uint64)
        assert np.allclose(np.exp(model.log_probs(keys)).sum(axis=0), 1, atol=1e-4)


def test_long_texts_are_scored_in_parts(monkeypatch):
    model = langid.train({"x": ["abra cadabra abba"] * 2, "y": ["zyx zyz"] * 2})
    numbers = model.numbers()
    texts = ["abra " * 40, "", "zyx", "12 ", "x" * 130]
    whole = model.entropies(texts, numbers)
    monkeypatch.setattr(langid, "PART", 64)
    parts = model.entropies(texts, numbers)
    assert parts[2].tolist() == whole[2].tolist() and np.allclose(parts[0], whole[0], atol=0.3)
    assert [r[0] for r in model.predict(texts, numbers)] == ["x", "und", "y", "und", "y"]


def test_language_query(llm, queries):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.lang for r in llm.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries["op7_language_id"](llm, sf).collect()
    assert {r.doc_id for r in got} == labels.keys()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert np.mean([r.lang_pred == labels[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in got) and not any(r.rejected for r in got)


def test_sample_is_the_smallest_hashes(llm, monkeypatch):
    rows = [("x" if i % 3 else "y", f"text number {i // 2} with letters") for i in range(3000)]
    rows += [("z", "one copy")] * 500 + [(None, "no label"), ("x", None), ("y", "12")]
    df = llm.createDataFrame(rows, "lang string, text string")
    got = {}
    monkeypatch.setattr(langid, "train", lambda samples: got.update(samples))
    langid.fit(df, per_lang=5)
    hashes = df.where("lang is not null and text rlike '[a-z]'").selectExpr(
        "lang", "text", "xxhash64(text) h").distinct().orderBy("h").collect()
    for lang in "xyz":
        assert got[lang] == [r.text for r in hashes if r.lang == lang][:5]


def test_language_odd_rows(llm, odd_docs, no_docs):
    sf = "/root/testdata/sf0.001"
    model = langid.fit(llm.read.parquet(f"{sf}/documents.parquet"), per_lang=50)
    found = langid.identify(odd_docs.withColumnRenamed("g", "score"), model)
    got = found.collect()
    assert len(got) == odd_docs.count()
    assert set(odd_docs.columns) - {"g"} <= set(found.columns)
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters)
        if not letters:
            assert r.rejected and r.score == 0
    assert [r.rejected for r in got if r.doc_id == 9] == [True]  # one letter 3000 times
    assert langid.identify(no_docs, model).collect() == []
    nothing = langid.fit(no_docs)
    assert {r.lang_pred for r in langid.identify(odd_docs, nothing).collect()} == {"und"}


def test_more_letters_than_numbers():
    letters = [chr(c) for c in range(0x110000) if chr(c).isalpha() and chr(c).lower() == chr(c)][:70_000]
    assert len(letters) == 70_000
    half = len(letters) // 2
    texts = {"x": ["".join(letters[k:half:4]) for k in range(4)] * 2,
             "y": ["".join(letters[half + k::4]) for k in range(4)] * 2}
    model = langid.train({k: [t for t in v for _ in range(2)] for k, v in texts.items()})
    numbers = model.numbers()
    low = langid._letters()
    assert (numbers[[ord(c) for c in letters if low[ord(c)] in model.alphabet]] >= 2).all()
    assert len(model.alphabet) > langid.NUMBERS
    assert [p[0] for p in model.predict([texts["x"][0], texts["y"][1]], numbers)] == ["x", "y"]
