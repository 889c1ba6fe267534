"""Exact token ids and counts of whole texts with public tokenizer files.

**Cutting at proven boundaries.** For the supported pre-tokenizers (byte level
with its own pattern, or a pattern split that drops white space) no token ever
reaches over a single space between two characters that are not white space:
no alternative of the patterns holds a character followed by a space, nothing
looks behind, normalisation composes nothing with a space, and no added token
holds one. So the ids of a text are the ids of its parts between such spaces.
``stable_spaces`` checks the tokenizer file for these conditions; any other
tokenizer encodes whole texts.

* Texts up to ``chunk`` characters: every distinct word is encoded once per
  worker (in one long string, told apart by the offsets) and texts are put
  together from the words' ids.
* Longer texts: overlapping chunks are encoded with offsets and spliced where
  both encodings agree, token by token, between two proven boundaries inside
  the overlap. Where they do not, or there is no such boundary, the overlap is
  widened, if need be up to the rest of the text. Memory is bounded by the
  chunk, unless a text has no boundary at all.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_WORD = 64  # longer words are encoded but not remembered
MAX_WORDS = 700_000  # words a worker remembers (the first it meets, so the common ones)
SLICE_BYTES = 1 << 20  # text taken from an Arrow batch at a time
PART = 1 << 18  # characters of a text that are split into words at a time
_BOUNDARY = re.compile(r"(?<=\S) (?=\S)")


def stable_spaces(config: dict) -> str | None:
    """How words are told apart: ``"kept"`` (the space belongs to the next
    word), ``"dropped"`` (white space vanishes) or None (not proven)."""
    if any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"]
           for t in config.get("added_tokens", [])):
        return None
    if config.get("post_processor") or config.get("model", {}).get("type") != "BPE":
        return None
    pre = config.get("pre_tokenizer") or {}
    if (pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]
            and not config.get("normalizer")):
        return "kept"
    steps = pre.get("pretokenizers", [])
    norms = [n["type"] for n in (config.get("normalizer") or {}).get("normalizers", [])]
    if ([s["type"] for s in steps] == ["Split", "ByteLevel"] and not steps[1]["use_regex"]
            and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
            and set(norms) <= {"NFC", "Replace", "Lowercase"}
            and re.sub(r"\[\^?(\\[spLN]|\{|\}|[LN])+\]\+?", "", steps[0]["pattern"]["Regex"])
            .replace(" ", "x") == "'s|'t|'re|'ve|'m|'ll|'d|||"):
        return "dropped"
    return None


def boundaries(text: str, step: int) -> Iterator[int]:
    """Places of spaces between non-white characters, ``step`` or more apart."""
    at = 0
    while m := _BOUNDARY.search(text, at + step):
        at = m.start()
        yield at


class _Words(dict):
    """Number of each word; -1 for what cannot be cut off at spaces or is long."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []  # numbered, but not yet encoded
        self.flat = _Flat()

    def __missing__(self, word: str) -> int:
        if not word or len(word) > MAX_WORD or word[0].isspace() or word[-1].isspace():
            return -1
        self[word] = number = len(self)
        self.fresh.append(word)
        return number

    def trim(self) -> None:
        """Forget the latest words beyond ``MAX_WORDS``."""
        while len(self) > MAX_WORDS:
            self.popitem()
        self.flat.trim(len(self))


class Encoder:
    """Ids of texts under one tokenizer file (``.json`` or ``.model``)."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core
        self.spaces = None
        if path.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._whole = lambda texts: model.encode(texts, num_threads=1)
            return
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self._whole = lambda texts: [e.ids for e in self.library.encode_batch_fast(
            texts, add_special_tokens=False)]
        with open(path, encoding="utf-8") as file:
            self.spaces = stable_spaces(json.load(file))
        self.words, self.firsts = _Words(), _Words()
        # Under "kept", a word's first token, and no other, begins with the space.
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.leads = np.zeros(max(vocab.values()) + 1, bool)
        self.leads[[i for t, i in vocab.items() if t.startswith("\u0120")]] = True

    def _learn(self) -> None:
        """Encode the words that were numbered since the last call."""
        new, self.firsts.fresh = self.firsts.fresh, []
        if new:  # nothing stands before the first word of a text
            ids = self._whole(new)
            self.firsts.flat.extend(np.array([i for x in ids for i in x], np.int32),
                                    np.array([len(x) for x in ids], np.int64))
        new, self.words.fresh = self.words.fresh, []
        for at in range(0, len(new), 4096):
            part = new[at:at + 4096]
            text = "".join(" " + w for w in part)
            start = np.cumsum([0] + [len(w) + 1 for w in part])
            if self.spaces == "kept":
                ids = np.array(self._whole([text])[0], np.int32)
                word = np.cumsum(self.leads[ids]) - 1
                right = not len(ids) or word[0] == 0 and word[-1] == len(part) - 1
            else:
                enc = self.library.encode(text, add_special_tokens=False)
                ids = np.array(enc.ids, np.int32)
                offsets = np.array(enc.offsets, np.int64).reshape(-1, 2)
                word = np.searchsorted(start, offsets[:, 0], "right") - 1
                right = not (offsets[:, 1] > start[word + 1]).any()
            if not right:
                raise AssertionError("words and tokens do not align")
            self.words.flat.extend(ids, np.bincount(word, minlength=len(part)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and the number of ids of each."""
        if self.spaces is None:
            ids = self._whole(texts)
            return (np.concatenate([np.array(x, np.int32) for x in ids] or [np.zeros(0, np.int32)]),
                    np.array([len(x) for x in ids], np.int64))
        out, counts = [], np.zeros(len(texts), np.int64)
        for k, row in self._rows(texts):
            if isinstance(row, str):
                ids = self._odd(row)
            else:
                ids = self.words.flat.ids_of(row[1])
                if row[0] is not None:
                    ids = np.concatenate([self.firsts.flat.ids_of(np.array([row[0]])), ids])
            out.append(ids)
            counts[k] += len(ids)
        return (np.concatenate(out) if out else np.zeros(0, np.int32)), counts

    def counts(self, texts: list[str]) -> np.ndarray:
        """The number of ids of each text."""
        if self.spaces is None:
            return np.array([len(x) for x in self._whole(texts)], np.int64)
        counts = np.zeros(len(texts), np.int64)
        for k, row in self._rows(texts):
            if isinstance(row, str):
                counts[k] += len(self._odd(row))
            else:
                counts[k] += int(self.words.flat.sizes[row[1]].sum())
                if row[0] is not None:
                    counts[k] += int(self.firsts.flat.sizes[row[0]])
        return counts

    def _rows(self, texts: list[str]) -> Iterator[tuple[int, tuple | str]]:
        """For each text, or part of a long one: its place and the numbers of its
        words (the first word's apart; None in a part that goes on), or the part
        itself where some word must not be cut off."""
        self.words.trim()
        self.firsts.trim()
        held, size = [], 0
        words, firsts = self.words.__getitem__, self.firsts.__getitem__
        for k, text in enumerate(texts):
            cuts = [0, *boundaries(text, PART), len(text)] if len(text) > 2 * PART else [0, len(text)]
            for a, b in zip(cuts, cuts[1:]):
                part = text[a:b]
                parts = part.split(" ")
                n = np.fromiter(map(words, parts[1:]), np.int64, len(parts) - 1)
                first = None if a else firsts(parts[0])
                odd = (first is not None and first < 0) or (len(n) and n.min() < 0)
                held.append((k, part if odd else (first, n)))
                size += b - a
                if size > 4 * PART:
                    self._learn()
                    yield from held
                    held, size = [], 0
        self._learn()
        yield from held

    def _odd(self, text: str) -> np.ndarray:
        """Ids of a text with runs of white space or very long words: its parts
        between proven boundaries, each encoded as it stands."""
        if not text:
            return np.zeros(0, np.int32)
        at = [0, *boundaries(text, 400), len(text)]
        parts = [text[a:b] for a, b in zip(at, at[1:])]
        return np.concatenate([np.array(x, np.int32) for x in self._whole(parts)])

    def count_long(self, text: str, chunk: int, overlap: int) -> int:
        """Number of ids of a long text by overlapping, respliced chunks."""
        n, total, begin = len(text), 0, 0
        left, end = self._span(text, 0, min(n, chunk)), min(n, chunk)
        while end < n:
            wide = overlap
            while True:
                at = max(end - wide, begin)
                stop = min(n, max(at + chunk, begin + 2 * (end - begin)))
                right = self._span(text, at, stop)
                cut = _splice(text, left, right, at, end)
                if cut is not None or at == begin:
                    break
                wide *= 2
            if cut is not None:
                total += int(np.searchsorted(left[1], cut) - np.searchsorted(left[1], begin))
                begin = cut
            # else: ``right`` starts at a proven boundary and holds all of ``left``
            left, end = right, stop
        return total + len(left[1]) - int(np.searchsorted(left[1], begin))

    def _span(self, text: str, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        enc = self.library.encode(text[a:b], add_special_tokens=False)
        offsets = np.array(enc.offsets, np.int64).reshape(-1, 2) + a
        return np.array(enc.ids, np.int64), offsets[:, 0], offsets[:, 1]


class _Flat:
    """Ids of numbered words, one after the other, in arrays that grow."""

    def __init__(self):
        self.n = self.used = 0
        self.ids = np.zeros(1 << 12, np.int32)
        self.starts, self.sizes = np.zeros(1 << 10, np.int64), np.zeros(1 << 10, np.int32)

    def extend(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        while self.n + len(sizes) > len(self.sizes):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used:self.used + len(ids)] = ids
        self.sizes[self.n:self.n + len(sizes)] = sizes
        self.starts[self.n:self.n + len(sizes)] = self.used + np.cumsum(sizes) - sizes
        self.n, self.used = self.n + len(sizes), self.used + len(ids)

    def trim(self, n: int) -> None:
        if n < self.n:
            self.n, self.used = n, int(self.starts[n])

    def ids_of(self, numbers: np.ndarray) -> np.ndarray:
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes, dtype=np.int64)
        if not len(ends) or not ends[-1]:
            return np.zeros(0, np.int32)
        return self.ids[np.repeat(self.starts[numbers] - ends + sizes, sizes) + np.arange(ends[-1])]


def _splice(text, left, right, at: int, end: int) -> int | None:
    """A proven boundary in [at, end) from which both encodings agree, token by
    token, up to the last one; None if there are no two such boundaries."""
    bounds = [m.start() for m in _BOUNDARY.finditer(text, max(at - 1, 0), min(end + 1, len(text)))
              if at < m.start() < end - 1]
    if len(bounds) < 2:
        return None
    first, last = bounds[0], bounds[-1]
    cut = bounds[len(bounds) // 2 - 1]
    a = slice(*np.searchsorted(left[1], (first, last)))
    b = slice(*np.searchsorted(right[1], (first, last)))
    same = all(np.array_equal(x[a], y[b]) for x, y in zip(left, right))
    return cut if same else None


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """The worker's encoder of a tokenizer file."""
    return Encoder(path)


def forget_encoders() -> None:
    """Release the words that an earlier stage has left in this worker."""
    if encoder.cache_info().currsize:
        encoder.cache_clear()
        pa.default_memory_pool().release_unused()


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES
           ) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``most`` bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes.astype(np.int64)) // most
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048, chunk: int = 32768, overlap: int = 1024) -> DataFrame:
    """Tokens of every whole text: ``doc_id, n_bytes, n_tokens, over_limit``.

    ``tokenizer`` is the path of a ``.json`` (tokenizers) or ``.model``
    (sentencepiece) file that every executor has. No begin, end or added
    tokens; special strings in a text are handled as the library does by
    default. One row per input row (repeated rows repeat); a null text counts
    as empty: 0 bytes, 0 tokens. Null ids stay null. Other input columns are
    not read, so their names cannot clash. An empty table gives no rows.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for whole in batches:
            for batch in slices(whole):
                texts = ["" if t is None else t for t in batch.column("text").to_pylist()]
                long = [k for k, t in enumerate(texts) if len(t) > chunk and enc.spaces]
                counts = np.zeros(len(texts), np.int64)
                skip = set(long)
                rest = [k for k in range(len(texts)) if k not in skip]
                counts[rest] = enc.counts([texts[k] for k in rest])
                for k in long:
                    counts[k] = enc.count_long(texts[k], chunk, overlap)
                n_bytes = pc.fill_null(pc.binary_length(batch.column("text")), 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), n_bytes.cast(pa.int64()), pa.array(counts),
                     pa.array(counts > limit)], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        count, f"{id_col} {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
