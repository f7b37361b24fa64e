"""Personal data by weak supervision.

Each text is searched for base spans (exact patterns) and for wider
candidates.  Regex, structure, gazetteer and context labelers vote on every
candidate: 1 personal, -1 not, 0 no opinion.  Expectation-maximisation over
the counts of all vote patterns of the corpus estimates how often each labeler
says yes among the personal spans and among the others, where it has an
opinion at all, and so each pattern's probability.  The base patterns are
personal as given; what the other labelers say of them is what the candidates
are measured by.  The probabilities are the targets of a logistic span
classifier on the votes (but the regex labeler's, which only tells base spans
from the rest) and span features.  A candidate is added if the classifier is
sure and at least two labelers speak for it.

The corpus reaches the driver only as counts of (kind, votes, features)
patterns, whose number is fixed by the number of labelers and feature values.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsentinel.llm.common import find, pick, positional, stored

KINDS = ("email", "ip", "card", "phone")
#: A candidate is added at this probability or above.
ADD_AT = 0.9

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGIT = re.compile(r"[0-9]")

#: Wider patterns of candidates: addresses with "at" and "dot" spelled out,
#: numbers without a plus sign, cards with dots or slashes, other forms of IP
#: addresses.  A cheap pattern first tells whether a text can hold any.
_MARK = r" ?[(\[{<] ?(?:at|@) ?[)\]}>] ?"
_DOT = r"(?: ?[(\[{<] ?(?:dot|punkt|point|punto|\.) ?[)\]}>] ?| dot |\.)"
_V6 = re.compile(r":[0-9A-Fa-f]{1,4}:")
_WIDE = {
    "email": (
        re.compile(r"[(\[{<] ?(?:at|@) ?[)\]}>]| at [A-Za-z0-9-]{1,63} dot ", re.I).search,
        re.compile(
            rf"(?<![\w.%+-])[A-Za-z0-9_%+-]{{1,64}}(?:{_DOT}[A-Za-z0-9_%+-]{{1,64}}){{0,3}}"
            rf"(?:{_MARK}[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,4}}| at [A-Za-z0-9-]{{1,63}}(?: dot [A-Za-z0-9-]{{1,63}}){{1,4}})(?!\w)", re.I
        ),
    ),
    "ip": (
        lambda text: "::" in text or "[.]" in text or "(.)" in text or _V6.search(text),
        re.compile(
            r"(?<![\w:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,5})(?![\w:])"
            r"|(?<![\w.])[0-9]{1,3}(?:[(\[]\.[)\]][0-9]{1,3}){3}(?![\w.])"
        ),
    ),
    "card": (
        re.compile(r"[0-9]{4}[./_][0-9]{4}[./_]").search,
        re.compile(r"(?<![\w.])[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![\w.])"),
    ),
    "phone": (
        re.compile(r"[0-9][ ./-][0-9]{2,4}[ ./-]?[0-9]|\) ?[0-9]{3,4}[ .-][0-9]").search,
        re.compile(
            r"(?<![\w.+-])(?:00[1-9][0-9]{0,2}[ ./-])?(?:\([0-9]{2,5}\) ?|[0-9]{2,5}[ ./-])[0-9]{3,4}[ .-]?[0-9]{3,4}(?:[ .-][0-9]{2,4})?(?![\w-]|[./][0-9])"
        ),
    ),
}

# Gazetteers and cue words of the labelers.
TOP_DOMAINS = frozenset(
    "com org net edu gov mil int info biz name pro io app dev tech online site shop blog cloud email company agency solutions systems"
    " museum academy institute university group network software team world news media consulting design".split()
)
#: Calling codes of one and two digits; all others have three and begin with
#: one of the pairs.
SHORT_CODES = frozenset(
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
)
LONG_CODES = frozenset("21 22 23 24 25 26 29 35 37 38 42 50 59 67 68 69 80 85 87 88 96 97 99".split())
CUES = {
    "email": re.compile(r"mail|contact|write|reach|kontakt|schreib|correo|escrib|courriel|[ée]cri", re.I),
    "ip": re.compile(r"\bip\b|ipv|host|server|address|client|login|logged|adresse|direcci", re.I),
    "card": re.compile(r"card|visa|credit|payment|paid|charge|karte|tarjeta|carte|mastercard|amex", re.I),
    "phone": re.compile(r"phone|\btel\b|\btel[.:]|call|mobile|fax|\bcell|ring|telefon|handy|tel[ée]f|llam|appel|num[ée]ro|whatsapp", re.I),
}
COUNTER_CUES = re.compile(r"order|invoice|version|build|part|serial|isbn|page|figure|sum|total|\bno\.?\s*$|#\s*$|=\s*$", re.I)
LABELERS = ("regex", "structure", "gazetteer", "cue", "counter_cue", "digits")
#: Labelers that must speak for a candidate that is added.
SUPPORT = 2
#: Characters before a span that the context labelers read.
CONTEXT = 40


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # From each "@" back to the start of the local part and on through the
    # domain: every start inside one local part fails or matches alike.
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            free = match.end()
        else:
            free = at + 1
        at = text.find("@", free)


def _base(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans (kind, start, end) and the matches that their checks drop."""
    kept = [(0, s, e) for s, e in _emails(text)]
    dropped = []
    if not _DIGIT.search(text):
        return kept, dropped
    for m in _IP.finditer(text):
        fine = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups())
        (kept if fine else dropped).append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19:
            (kept if luhn(digits) else dropped).append((2, *m.span()))
    for m in _PHONE.finditer(text):
        digits = sum(map(m.group().count, "0123456789"))
        (kept if 10 <= digits <= 15 else dropped).append((3, *m.span()))
    return kept, dropped


def _votes(kind: int, text: str, start: int, end: int, regex_vote: int) -> tuple[int, ...]:
    span, before = text[start:end], text[max(0, start - CONTEXT) : start]
    digits = re.sub(r"[^0-9]", "", span)
    name = KINDS[kind]
    if name == "email":
        last = re.split(r"[^A-Za-z0-9-]+", span)[-1].lower()
        # Two letters are a country's domain; but "at" and "dot" are words, and
        # without brackets any prose may have them.
        prose = re.search(r" at .* dot ", span, re.I) is not None
        structure = -1 if not last.isalpha() or len(last) < 2 else 0 if prose else 1
        gazetteer = 1 if last in TOP_DOMAINS or (len(last) == 2 and last.isalpha() and not prose) else 0
    elif name == "ip":
        parts = re.findall(r"[0-9]+", span)
        structure = 1 if ":" in span or all(p == "0" or (p[0] != "0" and len(p) <= 3 and int(p) <= 255) for p in parts) else -1
        gazetteer = 0 if ":" in span else -1 if parts[0] in ("0", "127", "255") else 1
    elif name == "card":
        structure = 1 if luhn(digits) else -1
        gazetteer = 1 if digits[0] in "3456" else -1
    else:
        # A year first, or two or four digits throughout, is a date or a range.
        dated = re.match(r"(?:19|20)[0-9]{2}[ ./-]", span) is not None
        structure = 1 if 9 <= len(digits) <= 15 and not dated else -1
        code = digits if span[0] == "+" else digits[2:] if digits.startswith("00") else ""
        gazetteer = 1 if code and (code[:1] in SHORT_CODES or code[:2] in SHORT_CODES or code[:2] in LONG_CODES) else 0
    cue = 1 if CUES[name].search(before) else 0
    counter = -1 if COUNTER_CUES.search(before) else 0
    same = -1 if digits and name != "ip" and (len(set(digits)) <= 2 or digits in "01234567890123456789") else 0
    return regex_vote, structure, gazetteer, cue, counter, same


def _features(kind: int, text: str, start: int, end: int) -> int:
    """Span features in one number: length (8 steps), separators (4), the
    character before and after (4 each)."""
    span = text[start:end]

    def side(c: str) -> int:
        return 0 if not c or c.isspace() else 1 if c.isalpha() else 2 if c.isdigit() else 3

    separators = (" " in span) + 2 * any(c in span for c in "-.(")
    value = min((end - start) // 5, 7)
    for size, part in ((4, separators), (4, side(text[start - 1 : start])), (4, side(text[end : end + 1]))):
        value = value * size + part
    return value


def _code(votes: tuple[int, ...]) -> int:
    code = 0
    for v in votes:
        code = code * 3 + v + 1
    return code


def _decode(code: int) -> list[int]:
    out = []
    for _ in LABELERS:
        out.append(code % 3 - 1)
        code //= 3
    return out[::-1]


def candidates(text: str | None) -> tuple[list[tuple], list[tuple]]:
    """Base spans and further candidates of a whole text, each
    ``(kind, start, end, votes, features)``; null is as empty.  Candidates
    that overlap a base span are not listed."""
    text = text or ""
    base, dropped = _base(text)
    base.sort(key=lambda s: (s[1], s[0]))
    wide = []
    for kind, name in enumerate(KINDS):
        possible, pattern = _WIDE[name]
        if possible(text):
            wide += [(kind, *m.span()) for m in pattern.finditer(text)]
    others, i = [], 0
    for kind, s, e in sorted(dropped + wide, key=lambda x: (x[1], x[0])):
        while i < len(base) and base[i][2] <= s:
            i += 1
        # Spans are sorted by start: if any overlaps, the first that has not
        # ended does.
        if i == len(base) or base[i][1] >= e:
            others.append((kind, s, e))
    mark = lambda k, s, e, v: (k, s, e, _code(_votes(k, text, s, e, v)), _features(k, text, s, e))
    failed = set(dropped)
    return [mark(*x, 1) for x in base], [mark(*x, -1 if x in failed else 0) for x in others]


@dataclass
class Model:
    """P(yes | personal or not) per kind and labeler where it has an opinion,
    the weights of the span classifier, and the share of personal ones among
    the candidates of each kind.  Without any candidate nothing is added."""

    reliability: np.ndarray
    weights: np.ndarray
    prior: np.ndarray

    def probability(self, kind: int, votes: int, features: int) -> float:
        z = float(_design(kind, votes, features) @ self.weights)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

    def adds(self, kind: int, votes: int, features: int, at: float) -> bool:
        return sum(v > 0 for v in _decode(votes)) >= SUPPORT and self.probability(kind, votes, features) >= at


_SIZES = (8, 4, 4, 4)
_WIDTH = 1 + len(KINDS) + 3 * (len(LABELERS) - 1) + sum(_SIZES)


def _design(kind: int, votes: int, features: int) -> np.ndarray:
    x = np.zeros(_WIDTH)
    x[0] = x[1 + kind] = 1
    at = 1 + len(KINDS)
    for v in _decode(votes)[1:]:
        x[at + v + 1] = 1
        at += 3
    parts = []
    for size in reversed(_SIZES):
        parts.append(features % size)
        features //= size
    for size, part in zip(_SIZES, reversed(parts)):
        x[at + part] = 1
        at += size
    return x


def _posterior(kind: np.ndarray, votes: np.ndarray, reliability: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """P(personal) of vote patterns; a labeler without an opinion says nothing,
    and the regex labeler's yes is the base pattern itself."""
    yes, no = np.log(reliability), np.log(1 - reliability)
    odds = np.log(prior[kind] / (1 - prior[kind]))
    for j in range(votes.shape[1]):
        up, down = yes[kind, 1, j] - yes[kind, 0, j], no[kind, 1, j] - no[kind, 0, j]
        odds = odds + np.where(votes[:, j] > 0, up, np.where(votes[:, j] < 0, down, 0.0))
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


#: Votes that a labeler's assumed reliability counts as.
PRIOR_VOTES = 4.0


def fit_patterns(patterns: list[tuple[int, int, int, int]], rounds: int = 50) -> Model:
    """EM and the classifier from (kind, votes, features, count) rows."""
    labelers = len(LABELERS)
    reliability = np.full((len(KINDS), 2, labelers), 0.5)
    prior = np.full(len(KINDS), 0.5)
    weights = np.zeros(_WIDTH)
    weights[0] = -30.0
    if not patterns:
        return Model(reliability, weights, prior)
    kind, code, feature, count = (np.array(c, float if i == 3 else int) for i, c in enumerate(zip(*patterns)))
    votes = np.array([_decode(c) for c in code])
    base = votes[:, 0] > 0
    # Start from the majority of the votes.
    p = np.where(base, 1.0, 1 / (1 + np.exp(-votes.sum(1).astype(float))))
    for _ in range(rounds):
        for k in range(len(KINDS)):
            at = kind == k
            for side, q in ((0, 1 - p), (1, p)):
                for j in range(labelers):
                    yes, no = ((q * count)[at & (votes[:, j] == v)].sum() for v in (1, -1))
                    # Before any evidence a labeler is right three times of four.
                    reliability[k, side, j] = (yes + PRIOR_VOTES * (0.75 if side else 0.25)) / (yes + no + PRIOR_VOTES)
            open_ = at & ~base
            prior[k] = ((p * count)[open_].sum() + 1) / (count[open_].sum() + 2)
        new = np.where(base, 1.0, _posterior(kind, votes, reliability, prior))
        if np.abs(new - p).max() < 1e-9:
            break
        p = new
    # Logistic span classifier on the soft labels: Newton steps, ridge term.
    x = np.stack([_design(*row) for row in zip(kind, code, feature)])
    # The few candidates weigh as much as the many base spans.
    share = count / np.where(base, max(count[base].sum(), 1.0), max(count[~base].sum(), 1.0)) / 2
    weights = np.zeros(_WIDTH)
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        grad = x.T @ (share * (q - p)) + 1e-4 * weights
        hess = (x * (share * q * (1 - q))[:, None]).T @ x + 1e-4 * np.eye(_WIDTH)
        step = np.linalg.solve(hess, grad)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return Model(reliability, weights, prior)


_SPAN = "array<struct<kind:int,start:int,end:int,votes:int,features:int>>"
_SPAN_ARROW = pa.list_(pa.struct([(n, pa.int32()) for n in ("kind", "start", "end", "votes", "features")]))


def _as_spans(rows: list[list[tuple]]) -> pa.Array:
    flat = np.array([v for spans in rows for span in spans for v in span], np.int32).reshape(-1, 5)
    offsets = np.cumsum([0] + [len(spans) for spans in rows])
    values = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(5)], fields=list(_SPAN_ARROW.value_type))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, type=_SPAN_ARROW)


def _scan(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the base spans and candidates of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [candidates(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), _as_spans([f[0] for f in found]), _as_spans([f[1] for f in found])], ["doc_id", "base", "more"]
            )

    return pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, f"doc_id long, base {_SPAN}, more {_SPAN}"
    )


def _patterns(scanned: DataFrame) -> list[tuple[int, int, int, int]]:
    span = F.explode(F.concat("base", "more")).alias("s")
    rows = scanned.select(span).groupBy("s.kind", "s.votes", "s.features").count().orderBy("kind", "votes", "features").collect()
    return [tuple(r) for r in rows]


def fit(docs: DataFrame) -> Model:
    """The model of a corpus: one scan of every whole text."""
    return fit_patterns(_patterns(_scan(docs)))


def _final(base: list[tuple], more: list[tuple], model: Model, at: float) -> list[tuple[int, int, int]]:
    spans = [tuple(s[:3]) for s in base]
    end = -1
    for kind, s, e, votes, features in more:
        if s >= end and model.adds(kind, votes, features, at):
            spans.append((kind, s, e))
            end = e
    return sorted(spans, key=lambda x: (x[1], x[0], x[2]))


def _text(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def find_spans(docs: DataFrame, add_at: float = ADD_AT) -> DataFrame:
    """``documents`` → one row per input row: ``doc_id``, the base spans as
    text ``base``, all spans as text ``spans`` (``kind:start:end`` by start,
    then kind; code points, end exclusive), counts of base spans by kind and
    ``n_added``.

    Null and empty texts have no span; repeated rows give equal rows; an
    empty table gives no rows and a model that adds nothing; other columns
    are ignored.
    """
    scanned = stored(_scan(docs), "spans")
    model = fit_patterns(_patterns(scanned))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for base, more in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                base, more = ([tuple(s.values()) for s in x] for x in (base, more))
                base_spans = sorted((s[:3] for s in base), key=lambda x: (x[1], x[0]))
                spans = _final(base, more, model, add_at)
                n = [sum(s[0] == k for s in base) for k in range(len(KINDS))]
                out.append((_text(base_spans), _text(spans), *n, len(spans) - len(base)))
            cols = list(zip(*out)) or [()] * 7
            kinds = [pa.string(), pa.string(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, t) for c, t in zip(cols, kinds)]],
                ["doc_id", "base", "spans", *[f"n_{k}" for k in KINDS], "n_added"],
            )

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return scanned.mapInArrow(run, f"doc_id long, base string, spans string, {counts}, n_added long")


def masked(docs: DataFrame, model: Model, add_at: float = ADD_AT) -> DataFrame:
    """The documents with each span replaced by its kind in angle brackets
    (overlapping spans as one, under the first kind); ``n_chars``, if there,
    becomes the new length; other columns, their order and names unchanged."""

    @F.arrow_udf("string")
    def mask(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            out = []
            for t in batch.to_pylist():
                base, more = candidates(t)
                spans = _final(base, more, model, add_at)
                if spans:
                    parts, at = [], 0
                    for kind, s, e in spans:
                        if s >= at:
                            parts += [t[at:s], f"<{KINDS[kind].upper()}>"]
                        at = max(at, e)
                    t = "".join(parts) + t[at:]
                out.append(t)
            yield pa.array(out, pa.string())

    moved, names = positional(docs)
    text = f"_c{find(names, 'text')}"
    done = moved.withColumn("_new", mask(F.col(text)))
    if any(n.lower() == "n_chars" for n in names):
        chars = f"_c{find(names, 'n_chars')}"
        kind = dict(moved.dtypes)[chars]
        done = done.withColumn(chars, F.when(F.col("_new") == F.col(text), F.col(chars)).otherwise(F.char_length("_new").cast(kind)))
    return done.withColumn(text, F.col("_new")).select(*moved.columns).toDF(*names)
