"""Quality classifier: naive-Bayes-scaled indicators and a linear hinge-loss
model fitted by dual coordinate descent.

Features are indicators of n-grams of three kinds, each hashed into bins of
its own: byte n-grams (one to five) of the text's shape, in which letters
become ``a`` or ``A``, digits ``0``, runs of one letter class or of digits
collapse, punctuation and spaces stay; words and pairs of words, A-Z
lower-cased; and, for scripts that do not part their words, characters beyond
ASCII and pairs of them.  Each bin is scaled by its class log-count ratio; the linear
model on the scaled indicators is the support vector machine.  Margins become
probabilities by a logistic curve fitted on held-out halves.

The fit reads a bounded sample of labelled rows (``max_rows``, those with the
smallest hash of their id); scoring reads every whole text.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsentinel.llm.common import find, pick, positional

#: Bins of the shapes, of the words and of the characters beyond ASCII.
BITS, WORD_BITS, CHARACTER_BITS = 16, 16, 14
_WORDS_AT, _CHARACTERS_AT = 1 << BITS, (1 << BITS) + (1 << WORD_BITS)
BINS = _CHARACTERS_AT + (1 << CHARACTER_BITS)
ORDER = 5
#: Labelled rows that the fit reads at most.
MAX_ROWS = 4096
#: Bytes of text taken at once.
BLOCK = 1 << 20
THRESHOLD = 0.3


def _shape_table() -> bytes:
    table = bytearray(range(256))
    for i in range(256):
        c = chr(i)
        if i >= 128 or "a" <= c <= "z":
            table[i] = ord("a")
        elif "A" <= c <= "Z":
            table[i] = ord("A")
        elif "0" <= c <= "9":
            table[i] = ord("0")
        elif i <= 32:
            table[i] = 10 if c == "\n" else 32
    return bytes(table)


_SHAPE = _shape_table()


def _bins(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes * np.uint32(2654435761)) >> np.uint32(32 - bits)


def _words(text: bytes, flags: np.ndarray) -> None:
    """Indicators of words and pairs of neighbouring words."""
    words = text.lower().split()  # bytes: A-Z and the six ASCII spaces only
    for at in range(0, len(words), BLOCK):
        h = np.fromiter(map(zlib.crc32, words[max(at - 1, 0) : at + BLOCK]), np.uint32)
        flags[_WORDS_AT + _bins(h, WORD_BITS).astype(np.int64)] = True
        flags[_WORDS_AT + _bins(h[:-1] * np.uint32(31) + h[1:] + np.uint32(7), WORD_BITS).astype(np.int64)] = True


def _characters(text: bytes, flags: np.ndarray) -> None:
    """Indicators of characters beyond ASCII and pairs of neighbouring ones."""
    codes = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    for at in range(0, len(codes), BLOCK):
        c = codes[max(at - 1, 0) : at + BLOCK]
        far = c >= 128
        flags[_CHARACTERS_AT + _bins(c[far], CHARACTER_BITS).astype(np.int64)] = True
        pair = np.flatnonzero(far[1:] & far[:-1])
        flags[_CHARACTERS_AT + _bins(c[pair] * np.uint32(65599) + c[pair + 1], CHARACTER_BITS).astype(np.int64)] = True


def features(text: bytes | None, words: bool = True) -> np.ndarray:
    """Sorted bins of the indicators of a whole UTF-8 text (null: as empty, no
    bin); without ``words`` those of shapes only."""
    flags = np.zeros(BINS, bool)
    text = text or b""
    last = np.zeros(0, np.uint32)
    for at in range(0, len(text), BLOCK):
        s = np.frombuffer(text[at : at + BLOCK].translate(_SHAPE), np.uint8).astype(np.uint32)
        # The last symbols of the block before go on, as n-grams span blocks.
        s = np.concatenate([last, s])
        keep = np.ones(len(s), bool)
        run = (s == 97) | (s == 65) | (s == 48)
        keep[1:] = ~((s[1:] == s[:-1]) & run[1:])
        s = s[keep]
        gram = np.zeros(len(s), np.uint32)
        for n in range(1, min(ORDER, len(s)) + 1):
            gram = gram[: len(s) - n + 1] * np.uint32(257) + s[n - 1 :] + np.uint32(7919 * n)
            flags[_bins(gram, BITS)] = True
        last = s[-(ORDER - 1) :]
    if words:
        _words(text, flags)
        if not text.isascii():
            _characters(text, flags)
    return np.flatnonzero(flags if words else flags[:_WORDS_AT]).astype(np.int32)


@dataclass
class Model:
    """Weights by bin, bias, and the slope and offset of the logistic curve.
    With labels of one class, or none, every score is the smoothed share of
    label 1."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(BINS))
    bias: float = 0.0
    slope: float = 0.0
    offset: float = 0.0

    def margin(self, bins: np.ndarray) -> float:
        return float(self.weights[bins].sum() + self.bias)

    def score(self, bins: np.ndarray) -> float:
        z = self.slope * self.margin(bins) + self.offset
        return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))


#: Weights of the log-count ratios of words and characters next to those of
#: shapes.  The fit goes to the next one only if its loss on the halves that it
#: does not see is lower by two standard errors of the difference: words count
#: where they tell clearly more than the shapes do.
WORD_WEIGHTS = (0.0, 0.3, 1.0)
_OF_WORDS = np.arange(BINS) >= _WORDS_AT


def _svm(rows: list[np.ndarray], y: np.ndarray, cost: float, epochs: int, word_weight: float) -> tuple[np.ndarray, float]:
    """Weights by bin and bias: log-count ratios, then dual coordinate
    descent on the hinge loss."""
    if not word_weight:
        rows = [bins[: np.searchsorted(bins, _WORDS_AT)] for bins in rows]
    count = {c: np.ones(BINS) for c in (1, -1)}
    for bins, c in zip(rows, y):
        count[c][bins] += 1
    ratio = np.zeros(BINS)
    for kind, weight in ((~_OF_WORDS, 1.0), (_OF_WORDS, word_weight)):
        up, down = count[1][kind], count[-1][kind]
        ratio[kind] = weight * (np.log(up / up.sum()) - np.log(down / down.sum()))
    w, bias, dual = np.zeros(BINS), 0.0, np.zeros(len(rows))
    scaled = [ratio[bins] for bins in rows]
    norm = [float(v @ v) + 1 for v in scaled]
    rng = np.random.default_rng(0)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            bins, v = rows[i], scaled[i]
            gradient = y[i] * (w[bins] @ v + bias) - 1
            new = min(max(dual[i] - gradient / norm[i], 0.0), cost)
            step = (new - dual[i]) * y[i]
            if step:
                w[bins] += step * v
                bias += step
                dual[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4 * cost:
            break
    return w * ratio, bias


def _logistic(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the curve, by Newton steps on smoothed targets."""
    up, down = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    scale = max(float(np.abs(margins).max()), 1e-9)
    x = np.stack([margins / scale, np.ones(len(y))], 1)
    ab = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ ab, -30, 30)))
        grad = x.T @ (p - target) + 1e-3 * ab
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        ab -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(ab[0]) / scale, float(ab[1])


def fit_rows(
    rows: list[np.ndarray], labels: np.ndarray, cost: float = 0.1, epochs: int = 20, word_weights: tuple[float, ...] = WORD_WEIGHTS
) -> Model:
    """The model of labelled rows (bins of each, label 0 or 1).  Margins of
    the half that a fit does not see give the logistic curve, and by its log
    loss the weight of the words."""
    y = np.where(labels == 1, 1, -1)
    ones = int((y > 0).sum())
    if min(ones, len(y) - ones) < 2:
        share = (ones + 1) / (len(y) + 2)
        return Model(offset=math.log(share / (1 - share)))
    # Folds that hold both classes alike: every second row of each class.
    fold = np.zeros(len(y), int)
    for c in (1, -1):
        at = np.flatnonzero(y == c)
        fold[at[1::2]] = 1
    tried = []
    for weight in word_weights:
        margins = np.zeros(len(y))
        for k in (0, 1):
            learn, test = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            part = Model(*_svm([rows[i] for i in learn], y[learn], cost, epochs, weight))
            margins[test] = [part.margin(rows[i]) for i in test]
        slope, offset = _logistic(margins, y)
        loss = np.logaddexp(0, -y * (slope * margins + offset))
        if tried:
            gain = tried[-1][0] - loss
            if gain.mean() <= 2 * gain.std() / math.sqrt(len(y)):
                continue
        tried.append((loss, weight, slope, offset))
    _, weight, slope, offset = tried[-1]
    return Model(*_svm(rows, y, cost, epochs, weight), slope, offset)


def held_out(doc_id):
    """Rows whose label is never learned from."""
    return F.crc32(doc_id.cast("string")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, label: str = "quality") -> Model:
    """Fit on the labelled rows with the smallest id hashes, ``max_rows`` at
    most; labels other than 0 and 1, null ids and held-out ids are left out,
    a repeated label row counts once (the smaller label, where they differ).
    """
    known = (
        pick(labels, "doc_id", label).toDF("doc_id", "y")
        .filter(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("y").cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins = [_packed(features(t)) for t in b.column(2).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(bins, pa.binary())], ["doc_id", "y", "bins"])

    texts = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    # The broadcast side has max_rows rows of two numbers; texts stay in place.
    sample = texts.join(F.broadcast(known), "doc_id").select("doc_id", "y", "text")
    rows = (
        sample.mapInArrow(run, "doc_id long, y int, bins binary")
        .groupBy("doc_id", "y").agg(F.min("bins").alias("bins")).orderBy("doc_id").collect()
    )
    return fit_rows([_unpacked(r.bins) for r in rows], np.array([r.y for r in rows], int))


def _packed(bins: np.ndarray) -> bytes:
    """The bins as numbers, or as bits where these are shorter: BINS / 8
    bytes at most, whatever the length of the text."""
    if bins.nbytes < BINS // 8:
        return b"n" + bins.tobytes()
    flags = np.zeros(BINS, bool)
    flags[bins] = True
    return b"b" + np.packbits(flags).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    if data[:1] == b"n":
        return np.frombuffer(data, np.int32, offset=1)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, offset=1))[:BINS]).astype(np.int32)


def scorer(model: Model):
    """Text column → score column; runs inside Arrow batches."""

    # Words without a weight need not be looked up.
    words = bool(model.weights[_WORDS_AT:].any())

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([model.score(features(t, words)) for t in batch.cast(pa.binary()).to_pylist()], pa.float64())

    return score


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``documents`` → ``(doc_id, held_out, score, predicted)``.

    One row per input row; null and empty texts have no indicator and get the
    score of the bias; a null ``doc_id`` is scored like any other and is not
    held out; equal texts score alike; an empty table gives no rows.
    """
    docs = pick(docs, "doc_id", "text")
    return docs.select("doc_id", "text").withColumn("score", scorer(model)("text")).select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents at or above the threshold, columns unchanged."""
    moved, names = positional(docs)
    text = F.col(f"_c{find(names, 'text')}")
    return moved.withColumn("_score", scorer(model)(text)).filter(F.col("_score") >= threshold).select(*moved.columns).toDF(*names)
