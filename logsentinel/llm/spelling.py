"""Spelling variants by blocked Gram matrices.

Every word has a vector of letter counts.  One inserted or deleted letter
moves it by a squared distance of 1, one replaced letter by 2, so words that
are one edit apart lie at a squared distance of at most 2, and their lengths
are equal or adjacent.  Words are packed into blocks by their length and the
counts of a few letter classes, which an edit changes by at most one as well;
only adjacent blocks meet.  For two blocks the Gram matrix of their letter
counts (one matrix product) gives all squared distances; the pairs at most two
apart are checked letter by letter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsentinel.llm.common import pick, remove, stored_at

MIN_LETTERS = 6
MIN_COUNT = 5
#: One run in so many loses a letter.
DROP_EVERY = 199
#: How many times more frequent than a word its form must be.
TIMES = 5
#: Words in a block, and blocks of one key that a task meets on its side.
ROWS = 1024
SLICE = 8

_A_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Letter classes of the block keys; all other letters form the last class.
#: They are about equally frequent in European languages; which letters they
#: hold changes the size of the blocks, never the result.
CLASSES = ("etd", "aiou", "nrsl")
_FIRST, _LAST = 0xC0, 0xFF
_LETTERS = 26 + _LAST - _FIRST + 1

_PACKED = "l int, c0 int, c1 int, c2 int, block long, words string, counts binary"
_LINKS = "a string, na long, b string, nb long"


def word_counts(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, drop_every: int = DROP_EVERY) -> DataFrame:
    """``documents`` → ``(word, n)``: maximal letter runs of whole texts, A-Z
    lower-cased, one letter taken out of the runs whose hash ``drop_every``
    divides, counted over all documents (a null text has none, a null id
    hashes as an empty one)."""
    # Runs under the limit cannot give words, so they are not even matched.
    letters = f"[A-Za-z{chr(_FIRST)}-{chr(_LAST)}]{{{min_letters},}}"
    runs = pick(docs, "doc_id", "text").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all("text", F.lit(letters), F.lit(0))).alias("run"),
    ).select("id", F.translate("run", _A_Z, _A_Z.lower()).alias("run"))
    h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    at = (h % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    words = runs.select(F.when(h % drop_every == 0, cut).otherwise(F.col("run")).alias("word"))
    return (
        words.filter(F.char_length("word") >= min_letters)
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)
    )


def _class_count(letters: str) -> Column:
    return F.char_length("word") - F.char_length(F.translate("word", letters, ""))


def _pack(size: int):
    """Sorted ``(l, c0, c1, c2, word, n)`` rows → blocks of at most ``size``
    words of one key."""
    names = ["l", "c0", "c1", "c2", "block", "words", "counts"]
    kinds = [pa.int32()] * 4 + [pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), count()
        key, words, counts = None, [], []

        def block() -> pa.RecordBatch:
            values = [*([k] for k in key), [part << 32 | next(number)], [" ".join(words)], [np.array(counts, np.int64).tobytes()]]
            words.clear(), counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)], names)

        for b in batches:
            for *now, word, n in zip(*(c.to_pylist() for c in b.columns)):
                if words and (now != key or len(words) == size):
                    yield block()
                key = now
                words.append(word)
                counts.append(n)
        if words:
            yield block()

    return run


def _steps() -> list[tuple[int, int, int, int]]:
    """From a block's key to those of the blocks it meets, each unordered pair
    once: the same key, one more letter of any class, one letter of a class
    replaced by one of a later class."""
    unit = [(1, 0, 0), (0, 1, 0), (0, 0, 1), (0, 0, 0)]
    steps = [(0, 0, 0, 0), *((1, *u) for u in unit)]
    for i in range(4):
        for j in range(i + 1, 4):
            steps.append((0, *(b - a for a, b in zip(unit[i], unit[j]))))
    return steps


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of equally long words, one row each, and letter counts."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)
    slot = np.where(codes >= _FIRST, codes - np.uint32(_FIRST) + 26, codes - np.uint32(97)).astype(np.int64)
    at = slot + np.arange(len(words))[:, None] * _LETTERS
    return codes, np.bincount(at.ravel(), minlength=len(words) * _LETTERS).reshape(len(words), _LETTERS).astype(np.float32)


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of two code-point tables are exactly one edit apart;
    those of ``b`` are as long or one longer."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    front = np.cumprod(a == b[:, :-1], axis=1).sum(1)
    back = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return front + back >= a.shape[1]


def near_in_blocks(one: list[str], other: list[str], same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs that are exactly one edit apart, between a block
    and one of words as long or one letter longer (``same``: the block itself,
    each pair once)."""
    (ca, va), (cb, vb) = _letters(one), _letters(other)
    used = va.any(0) | vb.any(0)
    va, vb = va[:, used], vb[:, used]
    # With its squared lengths as two further columns, the product is the
    # negative squared distance.
    left = np.hstack([2 * va, -(va**2).sum(1, keepdims=True), -np.ones((len(va), 1), np.float32)])
    right = np.hstack([vb, np.ones((len(vb), 1), np.float32), (vb**2).sum(1, keepdims=True)])
    at = np.flatnonzero(left @ right.T >= -2)
    i, j = at // len(vb), at % len(vb)
    if same:
        i, j = i[i < j], j[i < j]
    fine = _one_edit(ca[i], cb[j])
    return i[fine], j[fine]


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        words, counts = ([], []), ([], [])
        for block, one, n, other_block, other, other_n in zip(*(c.to_pylist() for c in b.columns)):
            sides = one.split(" "), other.split(" ")
            pairs = near_in_blocks(*sides, block == other_block)
            for k, numbers in enumerate((n, other_n)):
                words[k].extend(sides[k][i] for i in pairs[k])
                counts[k].append(np.frombuffer(numbers, np.int64)[pairs[k]])
        cols = [pa.array(c, t) for k in (0, 1) for c, t in ((words[k], pa.string()), (np.concatenate(counts[k] or [np.empty(0, np.int64)]), pa.int64()))]
        yield pa.RecordBatch.from_arrays(cols, ["a", "na", "b", "nb"])


def near_words(words: DataFrame, rows: int = ROWS) -> tuple[DataFrame, str]:
    """``(word, n)``, words distinct, of letters a-z and U+00C0-U+00FF →
    ``(a, na, b, nb)``: the pairs exactly one edit apart, each once; and where
    they are stored."""
    key = ["l", "c0", "c1", "c2"]
    keyed = words.select(F.char_length("word").alias("l"), *[_class_count(c).alias(f"c{i}") for i, c in enumerate(CLASSES)], "word", "n")
    # Ranges reach into a key, so a key that holds many words is dealt over tasks.
    packed, path = stored_at(
        keyed.repartitionByRange(*key, "word").sortWithinPartitions(*key, "word").mapInArrow(_pack(rows), _PACKED), "word_blocks"
    )
    most = packed.groupBy(*key).count().agg(F.max("count")).first()[0] or 0
    slices = max(1, -(-most // SLICE))
    steps = F.array(*[F.struct(*[F.lit(x).alias(k) for k, x in zip(key, s)]) for s in _steps()])
    left = packed.withColumn("step", F.explode(steps)).select(
        *[(F.col(k) + F.col(f"step.{k}")).alias(k) for k in key], (F.col("step.l") == 0).alias("even"),
        F.pmod(F.xxhash64("block"), F.lit(slices)).alias("slice"), "block", "words", "counts",
        F.forall(F.array(*[F.col(f"step.{k}") for k in key]), lambda x: x == 0).alias("own"),
    )
    right = packed.select(
        *key, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("slice"),
        F.col("block").alias("other_block"), F.col("words").alias("others"), F.col("counts").alias("other_counts"),
    )
    met = left.join(right, [*key, "slice"]).filter(~F.col("own") | (F.col("block") <= F.col("other_block")))
    links, links_path = stored_at(
        met.select("block", "words", "counts", "other_block", "others", "other_counts").mapInArrow(_meet, _LINKS), "word_links"
    )
    remove(words.sparkSession, path)
    return links, links_path


def variants(docs: DataFrame, times: int = TIMES, **limits: int) -> DataFrame:
    """``documents`` → ``(word, form, root, n, n_near, form_n)`` for every
    word of `word_counts`: how many words are exactly one edit away, the most
    frequent of these (ties: the smallest in code-point order) if it occurs at
    least ``times`` as often as the word (else null), and the word at the end
    of the chain of forms (the word itself without one).

    Repeated rows count each time; empty and null texts and empty tables give
    no words.  The number of rounds that follow the chains is logarithmic in
    their length, which is at most log_times of the largest count.
    """
    words, words_path = stored_at(word_counts(docs, **limits), "words")
    links, links_path = near_words(words)
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("nb").alias("na"), F.col("a").alias("b"), F.col("na").alias("nb")))
    near = both.groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("nb")).alias("order"), F.col("b").alias("form"))).alias("best")
    ).select("word", "n_near", "best.form", (-F.col("best.order")).alias("form_n"))
    frequent = F.col("form_n") >= F.col("n") * times
    formed, formed_path = stored_at(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("form")).alias("form"), F.when(frequent, F.col("form_n")).alias("form_n"),
    ), "word_forms")
    spark, path = docs.sparkSession, None
    chain = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        # Every round doubles the steps that a chain has taken.
        on = chain.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved, new_path = stored_at(chain.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "word_roots")
        going = not moved.filter("moved").isEmpty()
        if path:
            remove(spark, path)
        chain, path = moved.select("word", "root"), new_path
        if not going:
            break
    result, _ = stored_at(
        formed.join(chain, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"), "variants"
    )
    for old in (words_path, links_path, formed_path, path):
        remove(spark, old)
    return result
