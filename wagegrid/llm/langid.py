"""Language identification by interpolated Kneser-Ney character models.

A text is lower-cased and reduced to its letters with single spaces between
runs of them. For every learned language a character model of order 4 gives
each character a probability: absolute discounting, interpolated with the next
lower order, whose counts are numbers of different left neighbours. The n-grams
of all languages share one sorted array of 64-bit keys per order (four 16-bit
letter numbers, so keys cannot collide); a lookup gives all languages' log
probabilities at once. The language with the lowest cross-entropy per character
wins. Of more than 65,534 learned letters the rarest share their numbers, in turn,
with others that are rare. A text is rejected when that cross-entropy is above what held-back
labelled windows of the language reach, by a quarter of the distance to letters
at random and with an allowance for short texts.

The models are fitted on a bounded sample: at most ``per_lang`` different
windows of at most ``window`` characters for each language, drawn by the hash
of their text from all labelled rows (whole texts are cut into windows, copies
count once). So the sample that reaches the driver is bounded by languages x
per_lang x window characters. Everything else covers all rows and whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .shared import store
from .tokens import forget_encoders, slices

ORDER = 4
SPACE, UNKNOWN = 0, 1  # numbers of the blank and of letters never learned
NUMBERS = 0xFFFE       # numbers of learned letters; the rarest share theirs
UNDETERMINED = "und"
PART = 1 << 18  # characters scored at a time


def _letters() -> np.ndarray:
    """For each code point its lower-case letter, 0 where it is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def _codes(texts: list[str], numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letter numbers of all texts, ORDER - 1 blanks before each, no blank run
    inside; the positions where texts begin and the letters each has."""
    pad = " " * (ORDER - 1)
    joined = "".join(pad + t for t in texts)
    raw = numbers[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    size = np.array([len(t) + ORDER - 1 for t in texts], np.int64)
    begin = np.cumsum(size) - size
    keep = np.ones(len(raw), bool)
    keep[1:] = (raw[1:] != SPACE) | (raw[:-1] != SPACE)
    for k in range(ORDER - 1):
        keep[begin + k] = True
    ends = begin + size
    after = np.concatenate([[0], np.cumsum(keep)])
    letters = np.concatenate([[0], np.cumsum(raw != SPACE)])
    # A blank that follows the padding directly is dropped like any second blank.
    return raw[keep], after[begin], letters[ends] - letters[begin]


def _keys(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit keys of the ORDER-grams that end at the positions ``at``."""
    wide = codes.astype(np.uint64)
    key = np.zeros(len(at), np.uint64)
    for back in range(ORDER - 1, -1, -1):
        key = key << np.uint64(16) | wide[at - back]
    return key


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.minimum(np.searchsorted(table, keys), max(len(table) - 1, 0))
    return place, (table[place] == keys) if len(table) else np.zeros(len(keys), bool)


@dataclass
class Model:
    """Sorted key arrays per order and the log values of every language."""

    langs: list[str]
    alphabet: np.ndarray          # letters in order of their numbers, from 2
    grams: list[np.ndarray]       # [order - 1]: sorted keys of n-grams
    logp: list[np.ndarray]        # [order - 1]: (n-grams, languages)
    contexts: list[np.ndarray]    # [order - 1]: sorted keys of contexts
    loglam: list[np.ndarray]      # [order - 1]: weight of the lower order
    floor: float                  # log of the uniform distribution
    limit: np.ndarray             # highest cross-entropy of held-back windows
    spread: np.ndarray            # deviation of one character's log probability

    def numbers(self) -> np.ndarray:
        """Letter number of every code point."""
        low = _letters()
        of = np.zeros(0x110000, np.uint16)
        nth = np.arange(len(self.alphabet))
        beyond = nth >= NUMBERS  # from the last number backwards
        nth[beyond] = NUMBERS - 1 - (nth[beyond] - NUMBERS) % NUMBERS
        of[self.alphabet] = nth + 2
        out = of[low]
        out[(low != 0) & (out == 0)] = UNKNOWN
        return out

    def log_probs(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Log probability of each key's last character, a column a language."""
        if order == 0:
            return np.full((len(keys), len(self.langs)), self.floor, np.float32)
        place, hit = _find(self.grams[order - 1], keys)
        out = np.empty((len(keys), len(self.langs)), np.float32)
        out[hit] = self.logp[order - 1][place[hit]]
        miss = ~hit
        if miss.any():
            lost = keys[miss]
            low = self.log_probs(lost & np.uint64((1 << 16 * (order - 1)) - 1), order - 1)
            ctx, known = _find(self.contexts[order - 1], lost >> np.uint64(16))
            low[known] += self.loglam[order - 1][ctx[known]]
            out[miss] = low
        return out

    def entropies(self, texts: list[str], numbers: np.ndarray
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: cross-entropy under each language, characters, letters.

        A text longer than ``PART`` is scored in parts of that size, each of
        which begins like a text.
        """
        cuts = [max(1, -(-len(t) // PART)) for t in texts]
        parts = [t[k * PART:(k + 1) * PART] for t, c in zip(texts, cuts) for k in range(c)]
        total, n, letters, at = [], [], [], 0
        while at < len(parts):  # bounded arrays
            end, size = at, 0
            while end < len(parts) and (end == at or size + len(parts[end]) <= PART):
                size += len(parts[end])
                end += 1
            for held, more in zip((total, n, letters), self._totals(parts[at:end], numbers)):
                held.append(more)
            at = end
        first = np.cumsum(cuts) - cuts
        total, n, letters = (np.add.reduceat(np.concatenate(x), first, axis=0)
                             for x in (total, n, letters))
        return -total / np.maximum(n, 1)[:, None], n, letters

    def _totals(self, texts: list[str], numbers: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: summed log probabilities, characters, letters."""
        codes, begin, letters = _codes(texts, numbers)
        at = np.ones(len(codes), bool)
        for k in range(ORDER - 1):
            at[begin + k] = False
        n = np.append(begin[1:], len(codes)) - begin - (ORDER - 1)
        total = np.zeros((len(texts), len(self.langs)))
        some = n > 0
        if some.any():
            first = (np.cumsum(n) - n)[some]
            total[some] = np.add.reduceat(
                self.log_probs(_keys(codes, np.flatnonzero(at))).astype(np.float64), first, axis=0)
        return total, n, letters

    def predict(self, texts: list[str], numbers: np.ndarray
                ) -> list[tuple[str, float, float, bool]]:
        """Per text: language, score, cross-entropy, rejected."""
        if not self.langs:
            return [(UNDETERMINED, 0.0, 0.0, True)] * len(texts)
        entropy, n, letters = self.entropies(texts, numbers)
        best = entropy.argmin(axis=1)
        low = entropy[np.arange(len(best)), best]
        # Posterior of the best language; evidence of at most 100 characters.
        weight = np.exp(-(entropy - low[:, None]) * np.minimum(n, 100)[:, None])
        score = 1.0 / weight.sum(axis=1)
        worst = self.limit[best] + 6 * self.spread[best] / np.sqrt(np.maximum(n, 1))
        return [(self.langs[b], float(s), float(e), bool(e > w)) if k
                else (UNDETERMINED, 0.0, 0.0, True)
                for b, s, e, w, k in zip(best, score, low, worst, letters)]


def _count(codes: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.ones(len(codes), bool)
    for k in range(ORDER - 1):
        at[begin + k] = False
    return np.unique(_keys(codes, np.flatnonzero(at)), return_counts=True)


def _counts_by_order(texts: list[str], numbers: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """[order - 1]: n-grams and counts; below the highest order the number of
    different characters that precede the n-gram."""
    codes, begin, _ = _codes(texts, numbers)
    out = [_count(codes, begin)]
    for order in range(ORDER - 1, 0, -1):
        out.append(np.unique(out[-1][0] & np.uint64((1 << 16 * order) - 1), return_counts=True))
    return out[::-1]


def train(samples: dict[str, list[str]]) -> Model:
    """Fit a model on sample texts by language (every fourth only calibrates)."""
    langs = sorted(samples)
    fit = {k: [t for i, t in enumerate(v) if i % 4 or len(v) < 4] for k, v in samples.items()}
    held = {k: [t for i, t in enumerate(v) if i % 4 == 0 or len(v) < 4] for k, v in samples.items()}
    low = _letters()
    seen, times = np.unique(np.concatenate([np.zeros(0, np.uint32)] + [
        low[np.frombuffer("".join(v).encode("utf-32-le", "surrogatepass"), np.uint32)]
        for v in fit.values()]), return_counts=True)
    if len(seen) > NUMBERS:  # the most frequent first
        seen = seen[np.argsort(-times, kind="stable")]
    alphabet = seen[seen > 0]
    letters = min(len(alphabet), NUMBERS)
    model = Model(langs, alphabet, [], [], [], [], -float(np.log(letters + 2)),
                  np.zeros(len(langs)), np.zeros(len(langs)))
    numbers = model.numbers()
    counts = [_counts_by_order(fit[k], numbers) for k in langs]
    below = None
    for order in range(1, ORDER + 1):
        grams = np.unique(np.concatenate([c[order - 1][0] for c in counts]))
        ctxs = np.unique(grams >> np.uint64(16))
        prob = np.zeros((len(grams), len(langs)))
        lam = np.ones((len(ctxs), len(langs)))
        for j, c in enumerate(counts):
            keys, n = c[order - 1]
            ones, twos = (n == 1).sum(), (n == 2).sum()
            cut = float(np.clip(ones / max(ones + 2 * twos, 1), 0.1, 0.95))
            ctx = np.searchsorted(ctxs, keys >> np.uint64(16))
            total = np.bincount(ctx, n, len(ctxs))
            kinds = np.bincount(ctx, minlength=len(ctxs))
            known = total > 0
            lam[known, j] = cut * kinds[known] / total[known]
            prob[np.searchsorted(grams, keys), j] = (n - cut) / total[ctx]
        if order == 1:
            lower = np.full((len(grams), len(langs)), 1.0 / (letters + 2))
        else:
            lower = below[np.searchsorted(model.grams[-1],
                                          grams & np.uint64((1 << 16 * (order - 1)) - 1))]
        prob += lam[np.searchsorted(ctxs, grams >> np.uint64(16))] * lower
        model.grams.append(grams)
        model.logp.append(np.log(prob).astype(np.float32))
        model.contexts.append(ctxs)
        model.loglam.append(np.log(lam).astype(np.float32))
        below = prob
    for j, k in enumerate(langs):
        entropy, n, _ = model.entropies(held[k], numbers)
        long = n >= min(50, n.max())
        worst = entropy[long, j].max()
        # A quarter of the way from there to letters at random.
        model.limit[j] = worst + 0.25 * max(-model.floor - worst, 0)
        codes, begin, _ = _codes(held[k], numbers)
        at = np.ones(len(codes), bool)
        for b in range(ORDER - 1):
            at[begin + b] = False
        model.spread[j] = model.log_probs(_keys(codes, np.flatnonzero(at)))[:, j].std()
    return model


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
        per_lang: int = 400, window: int = 20_000) -> Model:
    """Learn the languages of ``labelled`` from a bounded sample (see above).

    Rows with a null text or label teach nothing; neither do texts without a
    letter. With no usable row the model knows no language and every text is
    undetermined.
    """
    text = F.col(text_col)
    parts = (labelled.where(text.isNotNull() & F.col(lang_col).isNotNull()
                            & text.rlike(r"\p{L}"))
             .select(F.col(lang_col).alias("lang"), text.alias("text"))
             .withColumn("part", F.explode(F.sequence(
                 F.lit(0), F.floor((F.length("text") - 1) / window).cast("int"))))
             .withColumn("text", F.substr("text", F.col("part") * window + 1, F.lit(window)))
             .withColumn("h", F.xxhash64("text")).drop("part"))
    first = Window.partitionBy("lang").orderBy("h")
    # Hashes are even, so the smallest of a language lie below a bound that its
    # number of windows tells; only some per_lang rows each are ranked.
    enough = 4 * per_lang + 64
    bound = store(parts.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).select(
        "lang", F.when(F.col("n") <= enough, F.lit(2 ** 63 - 1)).otherwise(
            (F.lit(enough * 2.0 ** 64) / F.col("n") - F.lit(2.0 ** 63)).cast("bigint")).alias("top")),
        "langid-bounds")
    # Stored: Spark then knows its size and need not move the texts.
    drawn = store(parts.select("lang", "h").join(bound, "lang").where("h <= top").select("lang", "h")
                  .distinct().withColumn("n", F.row_number().over(first))
                  .where(F.col("n") <= per_lang).drop("n"), "langid-sample")
    rows = (parts.join(drawn, ["lang", "h"]).groupBy("lang", "h")
            .agg(F.min("text").alias("text")).collect())
    samples: dict[str, list[str]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["h"])):
        samples.setdefault(row["lang"], []).append(row["text"])
    return train(samples) if samples else Model([], np.zeros(0, np.uint32), [], [], [], [], 0.0,
                                                np.zeros(0), np.zeros(0))


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Add ``lang_pred, score, cross_entropy, rejected`` to every row.

    A null text, or one without a letter, is ``und`` with score 0, rejected.
    Columns of these names are replaced; all others, and repeated rows, stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample
    added = ("lang_pred", "score", "cross_entropy", "rejected")
    kept = docs.drop(*added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()
        learned, numbers = shared.value, None
        for whole in batches:
            if numbers is None:
                numbers = learned.numbers()
            for batch in slices(whole, text_col):
                texts = ["" if t is None else t for t in batch.column(text_col).to_pylist()]
                cols = zip(*learned.predict(texts, numbers))
                types = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
                out = [pa.array(c, t) for c, t in zip(cols, types)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *out], names=[*batch.schema.names, *added])

    out_schema = StructType(list(kept.schema.fields))
    for name, kind in zip(added, ("string", "double", "double", "boolean")):
        out_schema = out_schema.add(name, kind)
    return kept.mapInArrow(run, out_schema)
