"""SentencePiece models on the tokenizers library: encoding and decoding.

The model file's protobuf is parsed, and normaliser, space marker, unigram
scores (or the merges that a BPE model's scores imply) and byte fallback are
rebuilt as a ``tokenizers`` pipeline. Every distinct word is encoded once per
worker, in batches by the library's own threads, and verified against the
sentencepiece library; where the two differ the word's ids are those of
sentencepiece and its texts are marked.

Texts are cut at spaces between characters that are not white space. That is
exact when no piece holds the space marker behind another character and the
normaliser maps characters one by one (an identity one); other models encode
whole texts, which are verified as such.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import _Words, boundaries, slices

# Fixed values of the SentencePiece model format.
MARK = "▁"  # stands for a space
UNIGRAM, BPE = 1, 2
UNKNOWN_PIECE, CONTROL_PIECE, USER_PIECE = 2, 3, 4
THREADS = 2
LONG = 1 << 20  # characters; longer texts are encoded part by part


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protobuf message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                if kind != 2:
                    raise ValueError(f"unexpected wire type {kind}")
                size, at = _varint(data, at)
            value, at = data[at:at + size], at + size
        yield key >> 3, value


def parse_model(data: bytes) -> dict:
    """What encoding needs of a ModelProto."""
    model = {"pieces": [], "type": UNIGRAM, "bytes": False, "unk": 0, "charsmap": b"",
             "prefix": True, "squeeze": True, "suffix": False}
    for number, value in fields(data):
        if number == 1:
            piece = {"text": "", "score": 0.0, "kind": 1}
            for n, v in fields(value):
                if n == 1:
                    piece["text"] = v.decode()
                elif n == 2:
                    piece["score"] = struct.unpack("<f", v)[0]
                elif n == 3:
                    piece["kind"] = v
            model["pieces"].append(piece)
        elif number == 2:
            names = {3: "type", 24: "suffix", 35: "bytes", 40: "unk"}
            model |= {names[n]: v for n, v in fields(value) if n in names}
        elif number == 3:
            names = {2: "charsmap", 3: "prefix", 4: "squeeze"}
            model |= {names[n]: v for n, v in fields(value) if n in names}
    return model


def merges_of(pieces: list[dict]) -> list[tuple[str, str]]:
    """Merges in the order of the merged pieces' scores."""
    rank = {p["text"]: k for k, p in enumerate(pieces) if p["kind"] not in (
        UNKNOWN_PIECE, CONTROL_PIECE)}
    found = []
    for p in pieces:
        text = p["text"]
        if text in rank:
            found += [(-p["score"], rank[text[:k]], rank[text[k:]], text[:k], text[k:])
                      for k in range(1, len(text)) if text[:k] in rank and text[k:] in rank]
    return [(a, b) for *_, a, b in sorted(found)]


def rebuild(model: dict):
    """The ``tokenizers`` pipeline of a parsed model."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

    if model["suffix"]:
        raise ValueError("the space marker as a suffix is not supported")
    pieces = model["pieces"]
    unknown = pieces[model["unk"]]["text"]
    if model["type"] == UNIGRAM:
        # Control pieces never match a text.
        low = min(p["score"] for p in pieces) - 100.0
        vocab = [(p["text"], low if p["kind"] in (UNKNOWN_PIECE, CONTROL_PIECE) else p["score"])
                 for p in pieces]
        core = models.Unigram(vocab, unk_id=model["unk"], byte_fallback=bool(model["bytes"]))
    elif model["type"] == BPE:
        core = models.BPE({p["text"]: k for k, p in enumerate(pieces)}, merges_of(pieces),
                          unk_token=unknown, fuse_unk=True, byte_fallback=bool(model["bytes"]))
    else:
        raise ValueError(f"model type {model['type']} is not supported")
    steps = []
    if model["charsmap"]:
        steps.append(normalizers.Precompiled(model["charsmap"]))
    if model["squeeze"]:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if model["prefix"]:
        steps.append(normalizers.Prepend(MARK))
    steps.append(normalizers.Replace(" ", MARK))
    library = Tokenizer(core)
    library.normalizer = normalizers.Sequence(steps)
    ends = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model["prefix"]:
        ends.append(decoders.Strip(" ", 1, 0))
    library.decoder = decoders.Sequence(ends)
    user = [AddedToken(p["text"], normalized=False) for p in pieces if p["kind"] == USER_PIECE]
    if user:
        library.add_tokens(user)
    return library


def splits_at_spaces(model: dict) -> bool:
    """Whether words can be encoded one by one."""
    return (bool(model["prefix"]) and not model["squeeze"] and not model["charsmap"]
            and not any(p["kind"] == USER_PIECE for p in model["pieces"])
            and not any(MARK in p["text"].lstrip(MARK) for p in model["pieces"]))


class Codec:
    """Encodes and decodes under one model, verified against sentencepiece."""

    def __init__(self, path: str, threads: int = THREADS):
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        with open(path, "rb") as file:
            self.data = file.read()
        model = parse_model(self.data)
        self.library = rebuild(model)
        self.by_word = splits_at_spaces(model)
        self.words, self.equal = _Words(), [np.zeros(0, bool)]

    @cached_property
    def judge(self):
        """The sentencepiece library's own processor (not needed to decode)."""
        import sentencepiece
        return sentencepiece.SentencePieceProcessor(model_proto=self.data)

    def _verified(self, texts: list[str]) -> tuple[list[list[int]], list[bool]]:
        ids = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        want = self.judge.encode(texts, num_threads=1)
        same = [a == b for a, b in zip(ids, want)]
        return (ids if all(same) else want), same

    def _learn(self) -> None:
        new, self.words.fresh = self.words.fresh, []
        if new:
            ids, same = self._verified(new)  # the marker before each is the model's own prefix
            self.words.flat.extend(np.array([i for x in ids for i in x], np.int32),
                                   np.array([len(x) for x in ids], np.int64))
            self.equal.append(np.array(same))

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[bool]]:
        """Ids of each text, and whether both libraries agree on it."""
        if not self.by_word:
            ids, same = self._verified(texts)
            return [np.array(x, np.int32) for x in ids], same
        before = len(self.words)
        self.words.trim()
        if len(self.words) < before:
            self.equal = [np.concatenate(self.equal)[:len(self.words)]]
        number, rows = self.words.__getitem__, []
        for text in texts:
            if len(text) > LONG:
                rows.append(None)
                continue
            parts = text.split(" ")
            rows.append(np.fromiter(map(number, parts), np.int64, len(parts)))
        self._learn()
        self.equal = [np.concatenate(self.equal)]
        out, equal = [], []
        for text, row in zip(texts, rows):
            if row is None or row.min() < 0 or MARK in text:
                ids, same = self._pieces(text)
            else:
                ids, same = self.words.flat.ids_of(row), bool(self.equal[0][row].all())
            out.append(ids)
            equal.append(same)
        return out, equal

    def _pieces(self, text: str) -> tuple[np.ndarray, bool]:
        """A text with runs of white space, markers or very long words: its parts
        between proven boundaries; the model's prefix stands for their spaces."""
        if not text:
            return np.zeros(0, np.int32), True
        parts, begin = [], 0
        for a in boundaries(text, 400):
            if text[a - 1] != MARK and text[a + 1] != MARK:
                parts.append(text[begin:a])
                begin = a + 1
        parts.append(text[begin:])
        out, equal = [], True
        for k in range(0, len(parts), 4096):
            ids, same = self._verified(parts[k:k + 4096])
            out += [np.array(x, np.int32) for x in ids]
            equal = equal and all(same)
        return np.concatenate(out), equal

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.library.decode_batch([x.tolist() for x in ids], skip_special_tokens=False)


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """The worker's codec of a model file."""
    return Codec(path)


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text",
           decoded: bool = False) -> DataFrame:
    """``id_col, n_bytes, n_tokens, ids`` (little-endian unsigned 32-bit),
    ``parity`` (both libraries agree) of every row.

    No begin or end tokens. A null text counts as empty: no ids. Repeated rows
    repeat, null ids stay null, other columns are not read. An empty table gives
    no rows. ``model`` is the path of a ``.model`` file on every executor. With
    ``decoded`` the same worker decodes the ids again, into a column ``decoded``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = codec(model)
        for whole in batches:
            for batch in slices(whole):
                texts = ["" if t is None else t for t in batch.column("text").to_pylist()]
                ids, same = lib.encode(texts)
                n_bytes = pc.fill_null(pc.binary_length(batch.column("text")), 0).cast(pa.int64())
                back = [pa.array(lib.decode(ids), pa.string())] if decoded else []
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), n_bytes, pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                     pa.array(same, pa.bool_()), *back],
                    names=[id_col, "n_bytes", "n_tokens", "ids", "parity", *["decoded"] * decoded])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"{id_col} {kind}, n_bytes bigint, n_tokens bigint, ids binary, parity boolean"
             + ", decoded string" * decoded)


def decode(rows: DataFrame, model: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Add the text of each row's ids; null or no ids give an empty text. A column
    named ``text_col`` is replaced."""
    kept = rows.drop(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = codec(model)
        for whole in batches:
            for batch in slices(whole, ids_col):
                ids = [np.frombuffer(x or b"", "<u4") for x in batch.column(ids_col).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(lib.decode(ids), pa.string())],
                    names=[*batch.schema.names, text_col])

    fields_ = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(run, f"{fields_}, `{text_col}` string")
