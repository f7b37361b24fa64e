"""Byte-pair encoding over a minimal acyclic transducer of frequent words.

The corpus is counted once; its most frequent words (pieces of the
tokenizer's splitting pattern) are encoded by exact merges and compiled into
an acyclic automaton with shared prefixes and suffixes.  Every arc carries
the number of words that sort before the words behind it, so the outputs
along a path add up to the word's index, and the index leads to its token
ids.  The arrays are written to one file that every executor fetches once and
maps into memory; its Python workers share the pages.  Words outside the
lexicon are merged exactly.
"""

from __future__ import annotations

import atexit
import hashlib
import heapq
import json
import os
import re
import shutil
import tempfile
import unicodedata
import uuid
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsentinel.llm.common import pick, stored

#: Words in the lexicon at most, and bytes in one of them.
WORDS = 1 << 17
WORD_BYTES = 48
#: Bytes of a word above which its merges are kept in a heap.
LONG = 64
#: Different words that a task counts before it hands them on, and characters
#: that it reads for them at most.
KEEP = 200_000
SEEN = 1 << 26
#: Rows whose texts a task takes out of a batch at once.
ROWS = 256
#: Parts in each of the two generations of an encoder's cache.
GENERATION = 100_000

#: Fixed value: the splitting pattern of the byte-level tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SPLIT = regex.compile(PATTERN)
#: A space whose next character is white space or missing: there, a piece may
#: reach across the space, so the text is split as a whole.
_LOOSE = re.compile(r" (?:\s|\Z)")
#: Marks that are one piece together, where they follow a word.
_MARKS = ".,;:!?%$&*#|)]}\""


@lru_cache(maxsize=1)
def _unsettled() -> re.Pattern:
    """Code points that Unicode 3.2 had not assigned: libraries of different
    age may class them differently, so the tokenizer's own splitter decides."""
    old, ranges, start = unicodedata.ucd_3_2_0, [], None
    for cp in range(0x80, 0x110001):
        new = cp < 0x110000 and not 0xD800 <= cp <= 0xDFFF and old.category(chr(cp)) == "Cn"
        if new and start is None:
            start = cp
        elif not new and start is not None:
            ranges.append((start, cp - 1))
            start = None
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) + "]")


def byte_letters() -> dict[int, str]:
    """The printable letter of each byte in the vocabulary file: printable
    Latin-1 bytes stand for themselves, the rest are numbered from U+0100."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(plain)))}


class Vocabulary:
    """Token ids, bytes and merge ranks from the tokenizer's file content."""

    def __init__(self, content: str):
        data = json.loads(content)
        letters = byte_letters()
        back = {c: b for b, c in letters.items()}
        vocab = data["model"]["vocab"]
        self.bytes = {i: bytes(back[c] for c in t) for t, i in vocab.items() if all(c in back for c in t)}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.bytes |= {i: t.encode() for t, i in self.special.items()}
        self.byte_id = [vocab[letters[b]] for b in range(256)]
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(data["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merge.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.of_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.table = [self.bytes.get(i, b"") for i in range(max(self.bytes) + 1)]
        self.splitter = None
        # The merges as arrays sorted by pair, and the byte pairs as a table.
        pairs = sorted((a << 32 | b, *m) for (a, b), m in self.merge.items())
        self.pair, self.rank, self.made = (np.array(c, np.int64) for c in (zip(*pairs) if pairs else ([], [], [])))
        self.first = np.array(self.byte_id, np.int64)

    def split(self, text: str) -> list[str]:
        """Pieces of a text without special tokens."""
        if not text.isascii() and _unsettled().search(text):
            if self.splitter is None:
                from tokenizers.pre_tokenizers import ByteLevel

                self.splitter = ByteLevel(add_prefix_space=False, use_regex=True)
            return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]
        return _SPLIT.findall(text)

    def merged(self, word: bytes) -> list[int]:
        """Exact merges of one word: the pair of lowest rank first, the
        leftmost of equal ones first."""
        return self._merged_long([self.byte_id[b] for b in word])

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of each pair among the merges sorted by pair, or -1."""
        want = left << 32 | right
        at = np.searchsorted(self.pair, want)
        at[at == len(self.pair)] = 0
        return np.where(self.pair[at] == want, at, -1) if len(self.pair) else np.full(len(want), -1)

    def merged_many(self, words: list[bytes]) -> list[bytes]:
        """`merged` of many words at once, as little-endian 32-bit ids: each
        round merges the best pair of every word that still has one."""
        out: list[bytes] = [b""] * len(words)
        short = []
        for i, w in enumerate(words):
            if len(w) > LONG:
                out[i] = array("I", self.merged(w)).tobytes()
            elif w:
                short.append(i)
        if not short:
            return out
        size = np.array([len(words[i]) for i in short])
        ids = self.first[np.frombuffer(b"".join([words[i] for i in short]), np.uint8)]
        word = np.repeat(np.array(short), size)
        none = np.int64(len(self.pair) + 1)

        def rank(at: np.ndarray) -> np.ndarray:
            """Rank of the pair that starts at each place (none at the end of
            a word) and the id it makes."""
            fine = at[(at + 1 < len(ids))]
            fine = fine[word[fine] == word[fine + 1]]
            m = self._ranks(ids[fine], ids[fine + 1])
            ranks[at] = none
            ranks[fine] = np.where(m >= 0, self.rank[m], none) if len(self.rank) else none
            makes[fine] = self.made[m] if len(self.made) else 0

        ranks, makes = np.empty(len(ids), np.int64), np.zeros(len(ids), np.int64)
        rank(np.arange(len(ids)))
        while len(ids):
            start = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            size = np.diff(np.append(start, len(ids)))
            low = np.minimum.reduceat(ranks, start)
            done = low == none
            if done.any():
                raw = ids.astype("<u4").tobytes()
                for w, a, n in zip(word[start[done]].tolist(), start[done].tolist(), size[done].tolist()):
                    out[w] = raw[4 * a : 4 * (a + n)]
                keep = np.repeat(~done, size)
                ids, word, ranks, makes = ids[keep], word[keep], ranks[keep], makes[keep]
                low, size = low[~done], size[~done]
                if not len(ids):
                    break
            at = np.flatnonzero(ranks == np.repeat(low, size))
            at = at[np.append(True, word[at[1:]] != word[at[:-1]])]  # the leftmost of each word
            ids[at] = makes[at]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, word, ranks, makes = ids[keep], word[keep], ranks[keep], makes[keep]
            at -= np.arange(len(at))
            before = at[at > 0] - 1
            rank(np.concatenate([before[word[before] == word[before + 1]], at]))
        return out

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same in n log n: a heap of pairs over a linked list."""
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def push(i: int) -> None:
            j = after[i]
            if j < n and (m := self.merge.get((ids[i], ids[j]))) is not None:
                heapq.heappush(heap, (m[0], i, ids[i], ids[j], m[1]))

        for i in range(n - 1):
            push(i)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i] if ids[i] is not None else n
            if j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], ids[j] = new, None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return [x for x in ids if x is not None]


@lru_cache(maxsize=2)
def _vocabulary(content: str) -> Vocabulary:
    return Vocabulary(content)


# --- the lexicon ---------------------------------------------------------


def minimal_automaton(words: Iterable[bytes]) -> dict[str, np.ndarray]:
    """Arrays of the minimal acyclic automaton of sorted, distinct words.

    State s has the arcs ``first[s] .. first[s + 1]``, sorted by byte, each
    with its label, target and output (words of s that sort before the ones
    behind the arc, the word that ends in s included); ``final`` marks ends.
    """
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []
    counts: list[int] = []

    def close(node: list) -> int:
        key = (node[0], tuple(node[1]))
        state = register.get(key)
        if state is None:
            state = register[key] = len(states)
            states.append(key)
            counts.append(node[0] + sum(counts[t] for _, t in node[1]))
        return state

    # The open path of the last word: [final, closed arcs, byte that leads on].
    path: list[list] = [[False, [], None]]
    last = b""
    for word in words:
        if word <= last and (word or last or path[0][0]):
            raise ValueError("words must be sorted and distinct")
        same = 0
        while same < min(len(word), len(last)) and word[same] == last[same]:
            same += 1
        while len(path) > same + 1:
            node = path.pop()
            path[-1][1].append((path[-1][2], close(node)))
        for byte in word[same:]:
            path[-1][2] = byte
            path.append([False, [], None])
        path[-1][0] = True
        last = word
    while len(path) > 1:
        node = path.pop()
        path[-1][1].append((path[-1][2], close(node)))
    root = close(path[0])
    first, label, target, output = [0], [], [], []
    for final, arcs in states:
        past = int(final)
        for byte, to in arcs:
            label.append(byte)
            target.append(to)
            output.append(past)
            past += counts[to]
        first.append(len(label))
    return {
        "first": np.array(first, np.int32), "label": np.array(label, np.uint8), "target": np.array(target, np.int32),
        "output": np.array(output, np.int32), "final": np.array([f for f, _ in states], np.uint8), "root": np.array([root], np.int32),
    }


def compile_lexicon(words: Iterable[str], vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    """Automaton of the words and, by word index, their token ids."""
    ordered = sorted({w.encode() for w in words})
    arrays = minimal_automaton(ordered)
    ids = [np.frombuffer(i, "<u4") for i in vocabulary.merged_many(ordered)]
    arrays["start"] = np.cumsum([0] + [len(i) for i in ids]).astype(np.int64)
    arrays["ids"] = np.concatenate([np.zeros(0, np.uint32), *ids]).astype("<u4")
    # Arcs as sorted keys: a state and a byte are found by binary search.
    state = np.repeat(np.arange(len(arrays["final"])), np.diff(arrays["first"]))
    arrays["key"] = state.astype(np.int64) << 8 | arrays["label"]
    return arrays


def save_lexicon(arrays: dict[str, np.ndarray], path: str) -> None:
    """One file: a line with the arrays' names, types, places and lengths,
    then the arrays at multiples of 64 bytes."""
    blocks, head, at = [], [], 0
    for name, a in arrays.items():
        raw = a.tobytes()
        head.append([name, a.dtype.str, at, len(a)])
        blocks.append(raw + bytes(-len(raw) % 64))
        at += len(blocks[-1])
    line = json.dumps(head).encode()
    line += b" " * (-(len(line) + 1) % 64) + b"\n"
    with open(path, "wb") as f:
        f.write(line)
        f.writelines(blocks)


class Lexicon:
    """The compiled lexicon, mapped into memory."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            line = f.readline()
        whole = np.memmap(path, np.uint8, "r")
        for name, kind, at, n in json.loads(line):
            at += len(line)
            setattr(self, name, np.asarray(whole[at : at + n * np.dtype(kind).itemsize].view(kind)))

    def find(self, words: list[bytes]) -> np.ndarray:
        """Index of each word, -1 where it is not in the lexicon: all words
        take one step through the automaton together."""
        n = len(words)
        size = np.fromiter(map(len, words), np.int64, n)
        index = np.full(n, -1, np.int64)
        if not n or not len(self.key):
            return index
        data = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(size) - size
        alive = np.flatnonzero((size > 0) & (size <= WORD_BYTES))
        state = np.full(n, self.root[0], np.int64)
        total = np.zeros(n, np.int64)
        for i in range(WORD_BYTES):
            alive = alive[size[alive] > i]
            if not len(alive):
                break
            want = state[alive] << 8 | data[start[alive] + i]
            arc = np.searchsorted(self.key, want)
            arc[arc == len(self.key)] = 0
            hit = self.key[arc] == want
            alive, arc = alive[hit], arc[hit]
            total[alive] += self.output[arc]
            state[alive] = self.target[arc]
            done = alive[size[alive] == i + 1]
            done = done[self.final[state[done]] == 1]
            index[done] = total[done]
        return index

    def tokens(self, index: np.ndarray) -> list[bytes]:
        """Token ids of the words with these indexes."""
        raw = memoryview(self.ids).cast("B")
        return [bytes(raw[4 * a : 4 * b]) for a, b in zip(self.start[index].tolist(), self.start[index + 1].tolist())]


def _texts(column: pa.Array) -> Iterator[str | None]:
    """The texts of a column, of which few are Python strings at once."""
    for at in range(0, len(column), ROWS):
        yield from column.slice(at, ROWS).to_pylist()


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, n)``: how often each space-separated word, with its space and
    without closing marks, occurs in the whole texts (words of up to
    `WORD_BYTES` bytes).  Tasks hand on partial counts, which Spark adds up
    before and after the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter = Counter()
        seen = 0

        def flush() -> pa.RecordBatch:
            words, n = pa.array(list(count), pa.large_string()), pa.array(list(count.values()), pa.int64())
            count.clear()
            words = pc.utf8_rtrim(words, characters=_MARKS)
            short = pc.less(pc.binary_length(words), WORD_BYTES)  # with its space, at most as long
            words = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), words.filter(short), pa.scalar(" ", pa.large_string()))
            return pa.RecordBatch.from_arrays([words.cast(pa.string()), n.filter(short)], ["word", "n"])

        for b in batches:
            for text in _texts(b.column(0)):
                if text:
                    count.update(text.split(" "))
                    seen += len(text)
                if len(count) > KEEP or seen > SEEN:
                    yield flush()
                    seen = 0
        yield flush()

    return pick(docs, "text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(docs: DataFrame, words: int = WORDS) -> list[str]:
    """The most frequent words, ``words`` at most: all whose count is above
    the lowest limit that leaves no more (counts from 1,024 on are ranked in
    steps of about one per cent).  The driver gets the histogram of counts
    and the words themselves."""
    n = F.col("n")
    step = F.when(n < 1024, n).otherwise(F.floor((F.log2(n) - 10) * 64) + 1024)
    counts = stored(word_counts(docs), "words").withColumn("step", step.cast("int"))
    limit, total = None, 0
    for row in counts.groupBy("step").count().orderBy(F.desc("step")).collect():
        total += row["count"]
        if total > words:
            break
        limit = row.step
    return [] if limit is None else [r.word for r in counts.filter(F.col("step") >= limit).select("word").collect()]


def build_lexicon(docs: DataFrame, vocabulary: str, words: int = WORDS) -> str:
    """Count the corpus, compile the pieces of its most frequent words and
    give the file to every executor; returns its name.  An empty corpus gives
    an empty lexicon."""
    vocab = _vocabulary(vocabulary)
    pieces = {p for w in frequent_words(docs, words) for p in vocab.split(w)}
    arrays = compile_lexicon(pieces, vocab)
    folder = tempfile.mkdtemp(prefix="lexicon-")  # the driver serves it to every executor
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, f"lexicon-{uuid.uuid4().hex}.bin")
    save_lexicon(arrays, path)
    docs.sparkSession.sparkContext.addFile(path)
    return os.path.basename(path)


class Encoder:
    """Encodes and decodes texts of one task."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        #: Ids of parts that follow a space, the space included, whose pieces
        #: are in the lexicon: those of late and, with half the room each,
        #: those of before.  Rare parts are known while their texts are encoded.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, pieces: list[str]) -> tuple[dict[str, bytes], set[str]]:
        """Ids of different pieces, from the lexicon or else merged, and which
        were merged."""
        raw = [p.encode() for p in pieces]
        index = self.lexicon.find(raw)
        hit, miss = np.flatnonzero(index >= 0), np.flatnonzero(index < 0).tolist()
        merged = [pieces[i] for i in miss]
        ids = dict(zip([pieces[i] for i in hit.tolist()], self.lexicon.tokens(index[hit])))
        ids.update(zip(merged, self.vocabulary.merged_many([raw[i] for i in miss])))
        return ids, set(merged)

    def _learn(self, parts: list[str], heads: list[str]) -> tuple[list[bytes], set[str]]:
        """Make the parts known, and give the ids of the heads and the parts
        that are not whole in the lexicon, which are rare.  A word of letters
        and the marks that close it are a piece each; other parts are split,
        and heads as what no space comes before."""
        known, split = self.known, self.vocabulary.split
        odd = "".join([p for p in parts if not p.isascii()])
        settled = not odd or not _unsettled().search(odd)
        words: dict[str, None] = {}
        closed: list[str] = []
        stems: list[str] = []
        rest: list[str] = []
        for part in parts:
            word = part.rstrip(_MARKS)
            if word.isalpha() and (settled or word.isascii() or not _unsettled().search(word)):
                if word != part:
                    closed.append(part)
                    stems.append(word)
                if word not in known:
                    words[word] = None
            else:
                rest.append(part)
        cut = [split(" " + p) for p in rest] + [split(h) for h in heads]
        own, marks = [" " + w for w in words], [p[len(w) :] for p, w in zip(closed, stems)]
        ids, merged = self._ids(list(dict.fromkeys(chain(own, marks, *cut))))
        known.update(zip(words, map(ids.__getitem__, own)))
        known.update(zip(closed, [known[w] + ids[m] for w, m in zip(stems, marks)]))
        joined = [b"".join([ids[p] for p in c]) for c in cut]
        known.update(zip(rest, joined))
        rare = {w for w, p in zip(words, own) if p in merged}
        rare.update([p for p, w, m in zip(closed, stems, marks) if w in rare or m in merged])
        rare.update([p for p, c in zip(rest, cut) if not merged.isdisjoint(c)])
        return joined[len(rest) :], rare

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Token ids of each text as little-endian 32-bit numbers.

        A text is cut at its special tokens, and what lies between at its
        spaces: no piece reaches across a space whose next character is not
        white space.  Other texts are split as a whole.
        """
        special = self.vocabulary.of_special
        runs: list[list] = []
        heads: list[str] = []
        parts: set[str] = set()
        for text in texts:
            text, own, at = text or "", [], 0
            cuts = [(m.start(), m.end(), m.group()) for m in special.finditer(text)] if special else []
            for start, end, token in [*cuts, (len(text), len(text), None)]:
                run = text[at:start] if cuts else text
                head, *rest = [run] if _LOOSE.search(run) else run.split(" ")
                own += [len(heads), rest]
                heads.append(head)
                parts.update(rest)
                if token is not None:
                    own.append(self.vocabulary.special[token].to_bytes(4, "little"))
                at = end
            runs.append(own)
        if len(self.known) > GENERATION:
            self.older, self.known = self.known, {}
        fresh = parts.difference(self.known)
        self.known.update({p: self.older[p] for p in fresh if p in self.older})
        first, rare = self._learn(list(fresh.difference(self.known)), heads)
        get = self.known.__getitem__
        out = [
            b"".join([first[x] if type(x) is int else x if type(x) is bytes else b"".join(map(get, x)) for x in own]) for own in runs
        ]
        for part in rare:
            del self.known[part]
        return out

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the decoded text; bytes that are no text are replaced."""
        raw = b"".join(map(self.vocabulary.table.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return raw.decode("utf-8", "replace").encode()


#: Characters encoded at once.
BLOCK = 1 << 20


def encoder_udf(vocabulary: str, lexicon: str):
    """Text column → struct of ids (binary), number of ids, digest of the ids
    and of the decoded text."""

    kind = "ids binary, n_tokens long, ids_sha256 string, decoded_sha256 string"

    @F.arrow_udf(kind)
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = Encoder(_vocabulary(vocabulary), Lexicon(SparkFiles.get(lexicon)))
        names, kinds = ["ids", "n_tokens", "ids_sha256", "decoded_sha256"], [pa.binary(), pa.int64(), pa.string(), pa.string()]

        def coded(texts: list[str | None]) -> pa.Array:
            out = [(ids, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(coder.decode(ids)).hexdigest()) for ids in coder.encode(texts)]
            cols = list(zip(*out)) or [()] * 4
            return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

        for batch in batches:
            some, size = [], 0
            for text in _texts(batch):
                some.append(text)
                size += len(text or "")
                if size > BLOCK:
                    yield coded(some)
                    some, size = [], 0
            yield coded(some)

    return encode


def encode(docs: DataFrame, tokenizer_file: str, words: int = WORDS) -> DataFrame:
    """``documents`` → one row per input row: ``doc_id, ids`` (little-endian
    32-bit numbers), ``n_tokens, ids_sha256, decoded_sha256``.

    Null and empty texts have no ids; the special token's text becomes its
    id; repeated rows give equal rows; an empty table gives no rows; other
    columns are ignored.  ``tokenizer_file`` is read on the driver.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        content = f.read()
    docs = pick(docs, "doc_id", "text")
    lexicon = build_lexicon(docs, content, words)
    out = docs.select("doc_id", encoder_udf(content, lexicon)("text").alias("e"))
    return out.select("doc_id", "e.ids", "e.n_tokens", "e.ids_sha256", "e.decoded_sha256")
