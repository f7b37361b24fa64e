"""Repeated lines, spelling variants and hard negatives: awkward rows, and
plain computations on rows made for them."""

import collections
import re
import zlib

import numpy as np
import pytest

from logsentinel.llm import hard_negatives, line_dedup, spelling
from logsentinel.llm.vectors import Best, products
from tests.conftest import SF_SMALL, spark  # noqa: F401
from tests.llm.cases import crowded, docs, rows

VECTORS = "vec_id long, embedding array<float>, label int"


def _lines(docs_in):
    """(doc_id, text) → (doc_id, n_lines, n_dropped, text), by dictionaries."""
    lower = str.maketrans({i: i + 32 for i in range(65, 91)})
    split = [(i, (t or "").split("\n")) for i, t in docs_in]
    holders = collections.defaultdict(set)
    for i, lines in split:
        for line in lines:
            key = line.strip(" \t\n\v\f\r").translate(lower)
            if len(key) >= 10:
                holders[key].add((i is None, i or 0))
    out = []
    for i, lines in split:
        kept = []
        for line in lines:
            held = holders.get(line.strip(" \t\n\v\f\r").translate(lower), ())
            if len(held) < 2 or min(held) == (i is None, i or 0):
                kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


LINES = [
    (5, "Same line here\nsame LINE here \nother"), (3, "x\n\tSAME line here\r\nlast one of three"), (3, "x\n\tSAME line here\r\nlast one of three"),
    (9, "same line here"), (4, None), (6, ""), (7, "\n\n"), (None, "same line here\nonly without an id"), (None, "only without an id"),
    (8, "naïve café\nNAÏVE CAFÉ"), (10, "naïve café\nNAïVE CAFé"), (11, "ééééééééé\nshort"), (12, "ééééééééé\nshort"), (13, "a line that repeats itself\na line that repeats itself"),
    (14, " padded line! \npadded line!"), (15, "padded line!"), (1, None), (2, "日本語日本語日本語日\nzzz"), (16, "日本語日本語日本語日"),
]


@pytest.mark.parametrize("found", (LINES, [(i % 3 or None, f"line number {i % 7} of all\nrow {i}") for i in range(60)]))
def test_lines_against_dictionaries(spark, found):  # noqa: F811
    df = docs(spark, [(i, t, "en", "s", 0) for i, t in found])
    assert rows(line_dedup.drop_repeated(df)) == _lines(found)
    assert rows(line_dedup.drop_repeated(crowded(df))) == _lines(found)


def test_lines_of_awkward_documents(spark):  # noqa: F811
    df = docs(spark)
    assert rows(line_dedup.drop_repeated(df)) == _lines([(r.doc_id, r.text) for r in df.collect()])
    assert line_dedup.drop_repeated(docs(spark, [])).collect() == []


def test_the_filters_miss_no_repeat(spark):  # noqa: F811
    """Every repeated key is suspected, and few others, past several slices of
    the once-seen filter."""
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 1 << 63, 60_000, dtype=np.uint64) << np.uint64(1)
    once = line_dedup.OnceSeen()
    seen = np.concatenate([once.add(hashes[i : i + 5000]) for i in range(0, len(hashes), 5000)])
    assert len(once.slices) > 2 and seen.mean() < 0.02
    assert once.add(hashes).all()
    texts = [f"line number {i} of the corpus" for i in range(3000)] + [f"line number {i} of the corpus" for i in range(0, 3000, 30)]
    df = docs(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)]).repartition(7)
    look = line_dedup.TwiceSeen(line_dedup.twice_seen(df))
    import xxhash

    hit = look.suspects(np.array([xxhash.xxh3_64_intdigest(t.encode()) for t in texts[:3000]], np.uint64))
    assert hit[::30].all() and hit.sum() < 130


def test_only_suspected_lines_are_shuffled(spark):  # noqa: F811
    df = docs(spark, [(i, f"line of document {i}\nThe line that all share", "en", "s", 0) for i in range(200)])
    before = line_dedup.stored_at
    tables = []
    line_dedup.stored_at = lambda d, n: tables.append(before(d, n)) or tables[-1]
    try:
        assert line_dedup.drop_repeated(df).filter("n_dropped = 1").count() == 199
    finally:
        line_dedup.stored_at = before
    assert 200 <= tables[0][0].count() < 220


def _words(docs_in):
    counts = collections.Counter()
    lower = str.maketrans({i: i + 32 for i in range(65, 91)})
    for i, text in docs_in:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def _one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _variants(n):
    words, form, near = list(n), {}, {}
    for w in words:
        near[w] = [x for x in words if _one_edit(w, x)]
        if near[w]:
            best = min(near[w], key=lambda x: (-n[x], x))
            if n[best] >= 5 * n[w]:
                form[w] = best
    out = []
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return sorted(out, key=repr)


def test_variants_against_all_pairs(spark):  # noqa: F811
    found = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = rows(spelling.variants(spark.read.parquet(f"{SF_SMALL}/documents.parquet")))
    assert got == _variants(_words(found)) and any(r[1] for r in got)


def test_variants_of_made_words(spark):  # noqa: F811
    """Chains of forms, ties, anagrams, letters beyond ASCII and classes that
    an edit crosses."""
    made = {"separate": 700, "seperate": 130, "seperat": 20, "seperatt": 5, "éclairs": 60, "eclairs": 10, "êclairs": 10, "àéîõüÿ": 30, "àéîõü": 900,
            "listen": 50, "silent": 50, "enlist": 50, "banana": 25, "bananas": 125, "bananax": 125, "STRASSE": 40, "straße": 8, "Straßen": 41, "xxxxxx": 5, "xxxxxxx": 24, "short": 999}
    found = [(i, (" ".join([w] * (n // 2)) + "-") * 2 + (w if n % 2 else "")) for i, (w, n) in enumerate(made.items())] + [(None, "listen"), (50, None), (51, "")]
    df = docs(spark, [(i, t, "en", "s", 0) for i, t in found])
    want = _variants(_words(found))
    assert rows(spelling.variants(df)) == want
    assert rows(spelling.variants(crowded(df))) == want
    chain = {r[0]: r[2] for r in want}
    assert chain["seperatt"] == "separate"
    assert spelling.variants(docs(spark, [])).collect() == []


@pytest.mark.parametrize("size", (3, 64))
def test_small_blocks_meet_all(spark, size):  # noqa: F811
    """Dense words in blocks of any size: every pair exactly once."""
    rng = np.random.default_rng(size)
    words = sorted({"".join(rng.choice(list("abeiÿß"), rng.integers(6, 9))) for _ in range(250)})
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    got = [tuple(sorted((r.a, r.b))) for r in spelling.near_words(df, rows=size)[0].collect()]
    assert sorted(got) == sorted((a, b) for i, a in enumerate(words) for b in words[i + 1 :] if _one_edit(a, b))


def _negatives(table):
    """The contract in loops, over (vec_id, label, integer vector)."""
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for anchor, label, v in table:
        if anchor % 50:
            continue
        scored = [(-dot(v, w), i, other) for i, other, w in table if i != anchor]
        for p, pid, _ in sorted(s for s in scored if s[2] == label)[:5]:
            fit = sorted(s for s in scored if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p)
            out += [(anchor, pid, k + 1, nid, -p, -s) for k, (s, nid, _) in enumerate(fit[:3])]
    return sorted(out)


def _ready(vectors):
    fine = [r for r in vectors if None not in r and r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    return [(i, (c + 1) % 10 if i % 7 == 0 else c, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, c in fine]


@pytest.mark.parametrize("blocks", ((2048, 512), (7, 3)))
def test_negatives_against_loops(spark, blocks):  # noqa: F811
    """Ties, equal vectors, negative and zero scores, rows that repeat an id,
    and windows that overlap; small blocks give the same."""
    rng = np.random.default_rng(11)
    vectors = [(int(i), (rng.integers(-3, 6, 4) / 256 * rng.choice([1, 8])).tolist(), int(rng.integers(0, 3))) for i in rng.permutation(400)]
    vectors += [(50, [0.0] * 4, 1), (100, vectors[5][1], 2), (100, vectors[6][1], 2), (3, [0.02] * 4, 0), (-50, [0.03] * 4, -3), (450, [0.01, 0.02], 1), (451, [], 1)]
    got = rows(hard_negatives.mine(spark.createDataFrame(vectors, VECTORS), rows=blocks[0], anchors=blocks[1]))
    assert got == sorted(_negatives(_ready(vectors)), key=repr) and len(got) > 50


def test_negatives_send_no_copies_of_the_anchors_to_the_driver(spark, monkeypatch):  # noqa: F811
    """Whatever is broadcast is first gathered by the driver.  The anchors met
    the rows in a broadcast join: a copy of them all for every cell, which the
    threshold did not see.  Many small cells give the same rows."""
    plans = []

    def kept(write):
        return lambda df, name: plans.append(df._jdf.queryExecution().toString()) or write(df, name)

    for name in ("stored", "stored_at"):
        monkeypatch.setattr(hard_negatives, name, kept(getattr(hard_negatives, name)))
    rng = np.random.default_rng(12)
    vectors = [(i, (rng.integers(-3, 6, 4) / 256).tolist(), int(rng.integers(0, 3))) for i in range(300)]
    vectors += [(100, [0.01] * 4, 2), (300, [900.0] * 4, 0), (301, [850.0] * 4, 1), (302, [950.0] * 4, 0), (303, [1e6] * 4, 0), (350, [1e6] * 4, 0)]
    monkeypatch.setattr(hard_negatives, "CELL", 64, raising=False)
    got = rows(hard_negatives.mine(spark.createDataFrame(vectors, VECTORS), rows=5, anchors=3))
    assert got == sorted(_negatives(_ready(vectors)), key=repr) and len(got) > 50
    assert len(plans) >= 5 and not [p for p in plans if "Broadcast" in p]


def test_awkward_vectors(spark):  # noqa: F811
    nan, inf = float("nan"), float("inf")
    vectors = [
        (0, [1.0, 2.0], 0), (0, [1.0, 2.0], 0), (1, [1.0], 1), (2, [0.9, 1.5], 2), (3, None, 0), (4, [None, 1.0], 0), (5, [nan], 0), (6, [inf], 0),
        (None, [9.0, 9.0], 0), (8, [3e38, 3e38], 1), (9, [1.0, 1.0], None), (50, [0.0, 0.0], 0), (10, [-1.0, 0.5], 0), (11, [1.5, 2.0], 1),
    ]
    df = spark.createDataFrame(vectors, VECTORS)
    got = rows(hard_negatives.mine(df))
    assert got and {r[0] for r in got} <= {0, 50} and rows(hard_negatives.mine(crowded(df))) == got
    assert not {r[3] for r in got} & {3, 4, 5, 6, 9, None}
    assert hard_negatives.mine(spark.createDataFrame([], VECTORS)).collect() == []


def test_products_and_best_are_exact():
    rng = np.random.default_rng(5)
    for most in (9, 1 << 11, 1 << 20, 1 << 29, 1 << 61):
        a, b = (rng.integers(-most, most, (5, 6)) for _ in range(2))
        exact = np.clip(a.astype(object) @ b.T.astype(object), -(1 << 63) + 1, (1 << 63) - 1)
        assert (products(a, b).astype(object) == exact).all()
    group, score, ident = rng.integers(0, 9, 500), rng.integers(-4, 5, 500), rng.permutation(500)
    best = Best(9, 3)
    for i in range(0, 500, 37):
        best.add(group[i : i + 37], score[i : i + 37], ident[i : i + 37])
    want = [t for g in range(9) for t in sorted((g, -s, i) for h, s, i in zip(group, score, ident) if h == g)[:3]]
    assert list(zip(best.group, -best.score, best.id)) == want
