"""Operators that SQL cannot express, against plain computations on whole
texts of the smallest tables."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from logsentinel.llm import bpe, fingerprints, html_text, license_scan, mixing, pii, quality, simhash, topk
from logsentinel.llm.components import connected_components
from logsentinel.llm.queries import QUERIES, tokenizer_path
from tests.conftest import SF_SMALL, spark  # noqa: F401
from tests.llm.cases import rows


@pytest.fixture(scope="module")
def texts(spark):  # noqa: F811
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}


def _components(n, linked):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_simhash_query(spark, texts):  # noqa: F811
    import xxhash

    def plain(text):
        w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))
        shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))

    got = {r.doc_id: r for r in QUERIES["op4_simhash_groups"](spark, SF_SMALL).collect()}
    ids = sorted(texts)
    fps = [plain(texts[i]) for i in ids]
    assert [got[i].fingerprint for i in ids] == [f"{f:016x}" for f in fps]
    pairs = [(a, b) for a in range(len(ids)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 2]
    assert [got[i].component_id for i in ids] == [ids[c] for c in _components(len(ids), pairs)]


@pytest.mark.parametrize("limit", (2, 5, 256))
def test_index_finds_every_link(spark, limit):  # noqa: F811
    """Dense clusters, chains and far values; a low limit sends nearly every
    list through the six-byte postings."""
    rng = np.random.default_rng(limit)
    fps = set()
    for centre in rng.integers(0, 1 << 63, 12, dtype=np.uint64).tolist():
        fps.add(centre)
        for _ in range(25):
            value = centre
            for _ in range(int(rng.integers(1, 5))):
                value ^= 1 << int(rng.integers(0, 64))
            fps.add(value)
    fps |= {0, 1, 3, 7, (1 << 64) - 1}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame(list(zip(signed, range(len(fps)))), "fp long, rep long")
    comps = dict(connected_components(simhash.links(df, limit=limit)).collect())
    pairs = [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 2]
    want = _components(len(fps), pairs)
    assert [comps.get(i, i) for i in range(len(fps))] == want


def test_components_of_a_long_path(spark):  # noqa: F811
    edges = spark.range(300).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    got = dict(connected_components(edges.unionByName(spark.createDataFrame([(900, 901), (5, 5)], "u long, v long"))).collect())
    assert got == {i: 0 for i in range(301)} | {900: 900, 901: 900}


def test_quality_query(spark):  # noqa: F811
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op5_quality_nbsvm"](spark, sf).toPandas().set_index("doc_id")
    known = spark.read.parquet(f"{sf}/labels.parquet").toPandas().set_index("doc_id").quality
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in got.held_out.items())
    assert (got.predicted == (got.score >= 0.3)).all() and got.score.between(0, 1).all()
    held = got.join(known, how="inner").query("held_out")
    assert (held.predicted == held.quality).mean() >= 0.95
    good, bad = held[held.quality == 1].score.to_numpy(), held[held.quality == 0].score.to_numpy()
    assert (good[:, None] > bad[None, :]).mean() >= 0.98


def test_quality_features_do_not_depend_on_blocks(monkeypatch):
    text = ("Abc def, 123!! " * 50 + "é\n").encode()
    whole = quality.features(text).tolist()
    monkeypatch.setattr(quality, "BLOCK", 7)
    assert quality.features(text).tolist() == whole


def test_bpe_query(spark, texts):  # noqa: F811
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    for r in QUERIES["op6_bpe_lexicon"](spark, SF_SMALL).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@pytest.mark.parametrize("generation", (bpe.GENERATION, 12))
def test_bpe_on_odd_texts(tmp_path, monkeypatch, generation):
    from tokenizers import Tokenizer

    monkeypatch.setattr(bpe, "GENERATION", generation)  # a small one turns over within a batch or two

    library = Tokenizer.from_file(tokenizer_path())
    vocabulary = bpe.Vocabulary(open(tokenizer_path()).read())
    odd = [
        "", " ", "  ", "a", " a", "a ", "a  b", "\n a\n\n b \t c", "it's we'll 's 'S x's", "<|endoftext|>", "a <|endoftext|> b<|endoftext|><|endoftext|> ",
        "<|endoftext", "naïve 日本語 🎉🎉 ١٢٣ ⅷ", "\x1c\x1f \x85 　x​ y", "a" * 3000, "ab" * 700, "x.y,,;!! (z)", "՘ ꟎x \U00010940 \U0001e900 ",
        "é ퟿", "don't   stop\r\n\r\n", "1234567 12 3", "\x00\x01", "𝒳𝒴 ß İ ŉ", "   b  ", "word.\nNext", "Á!?…—",
    ]
    words = {p for t in odd[:14] for p in vocabulary.split(t)} | {" the", " a", "b", "ab"}
    path = str(tmp_path / "lexicon")
    bpe.save_lexicon(bpe.compile_lexicon(words, vocabulary), path)
    coder = bpe.Encoder(vocabulary, bpe.Lexicon(path))
    for batch in (odd, odd[:7], odd[5:9], odd, [t + " the end" for t in odd]):
        for text, ids in zip(batch, coder.encode(batch)):
            want = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == want, repr(text)
            assert coder.decode(ids) == library.decode(want, skip_special_tokens=False).encode()


def _coder(folder, words):
    vocabulary = bpe.Vocabulary(open(tokenizer_path()).read())
    path = str(folder / "lexicon")
    bpe.save_lexicon(bpe.compile_lexicon({p for w in words for p in vocabulary.split(w)}, vocabulary), path)
    return bpe.Encoder(vocabulary, bpe.Lexicon(path)), path


def test_bpe_rare_parts_do_not_push_out_frequent_ones(tmp_path, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(bpe, "GENERATION", 10)
    library, (coder, _) = Tokenizer.from_file(tokenizer_path()), _coder(tmp_path, [" the", " end", " I'm", ".,"])
    met = []
    merged = coder.vocabulary.merged_many
    monkeypatch.setattr(coder.lexicon, "find", lambda words, find=coder.lexicon.find: met.extend(words) or find(words))
    monkeypatch.setattr(coder.vocabulary, "merged_many", lambda words: merged(words))
    for k in range(20):
        texts = [f"q the end.,{''.join(f' rare{chr(97 + k)}{chr(97 + i)}x x{k * 50 + i}.' for i in range(20))} I'm the. xö{chr(97 + k)}.,"]
        for text, ids in zip(texts, coder.encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert set(coder.known) <= {"the", "end", "end.,", "I'm", "the."}
    assert met.count(b" the") == met.count(b" end") == 1


def test_bpe_a_batch_is_encoded_in_parts(spark, tmp_path, monkeypatch):  # noqa: F811
    import pyarrow as pa

    coder, path = _coder(tmp_path, [" the", " end"])
    monkeypatch.setattr(bpe.SparkFiles, "get", lambda name: path)
    texts = ["the end of " * 100 + str(i) for i in range(2500)] + [None]
    encode = bpe.encoder_udf(open(tokenizer_path()).read(), "lexicon").func
    got = list(encode(iter([pa.array(texts), pa.array([], pa.string())])))
    assert max(len(a) for a in got) < 1500  # not all 2.7 million characters at once
    rows = [r for a in got for r in a.to_pylist()]
    assert [r["ids"] for r in rows] == coder.encode(texts)


def test_word_counts(spark):  # noqa: F811
    from collections import Counter

    texts = ["a b. b.; c!d é, " + "w" * 47 + " " + "w" * 48 + " " + "é" * 23 + " " + "é" * 24, None, "", "b \n x. . a" * 3]
    want = Counter(" " + part.rstrip(bpe._MARKS) for t in texts if t for part in t.split(" "))
    got = bpe.word_counts(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    assert {r.word: r.n for r in got} == {w: n for w, n in want.items() if len(w.encode()) <= bpe.WORD_BYTES} and len(got) > 5


def test_automaton_is_minimal_and_numbers_words():
    words = sorted(w.encode() for w in ("tap", "taps", "top", "tops", "stop", "stops", "", "a"))
    arrays = bpe.minimal_automaton(words)
    # Shared endings: states of the minimal automaton, counted by suffix sets.
    futures = {frozenset(w[i:] for w in words if w[:i] == p) for v in words for i in range(len(v) + 1) for p in [v[:i]]}
    assert len(arrays["final"]) == len(futures)

    def number(word):
        state, total = arrays["root"][0], 0
        for byte in word:
            arcs = range(arrays["first"][state], arrays["first"][state + 1])
            arc = next(a for a in arcs if arrays["label"][a] == byte)
            total, state = total + arrays["output"][arc], arrays["target"][arc]
        return total

    assert [number(w) for w in words] == list(range(len(words)))


def _base_spans(text):
    def luhn(digits):
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return sum(v - 9 * (v > 9) for v in doubled) % 10 == 0

    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for kind, pattern in ((1, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), (2, r"[0-9]([\x20-]?[0-9])+"), (3, r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            if kind == 1:
                fine = all(int(p) <= 255 for p in m[0].split("."))
            else:
                fine = 14 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 10 <= len(digits) <= 15
            if fine:
                out.append((m.start(), kind, m.end()))
    return [(k, s, e) for s, k, e in sorted(out)]


def test_pii_query(spark, texts):  # noqa: F811
    for r in QUERIES["op7_pii_weak_labels"](spark, SF_SMALL).collect():
        want = _base_spans(texts[r.doc_id])
        spelled = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in want)
        assert r.base_sha256 == hashlib.sha256(spelled.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for k, _, _ in want) for i in range(4)]
        assert set(filter(None, spelled.split(","))) <= set(r.spans.split(","))


def test_pii_base_spans_on_random_texts():
    rng = np.random.default_rng(3)
    letters = np.array(list("ab1234567890..@@--++() _%é\n") + ["@a.b", "1.2.3.4", "+1 ", "4111111111111111"])
    for _ in range(3000):
        text = "".join(rng.choice(letters, rng.integers(0, 40)))
        assert [s[:3] for s in pii.candidates(text)[0]] == _base_spans(text), repr(text)


def test_pii_long_runs_are_linear():
    for text in ("a" * 200_000 + "@", "1" * 200_000, "1." * 100_000, "@" * 200_000, "+1" + " (" * 100_000, "a.b@" * 50_000, "1 " * 100_000):
        pii.candidates(text)


def _planted(seed, counter=True, n=300):
    """Texts with plain and disguised personal data and with numbers that
    only look like it; and the disguised spans by document."""
    rng = np.random.default_rng(seed)
    pick = lambda *a: a[rng.integers(len(a))]
    num = lambda k: "".join(map(str, rng.integers(1, 9, k)))

    def card(sep):
        d = "4" + num(14)
        total = next(c for c in "0123456789" if pii.luhn(d + c))
        d += total
        return sep.join(d[i : i + 4] for i in range(0, 16, 4))

    texts, planted = [], {}
    for i in range(n):
        user, host = f"u{i}.x", pick("example", "post", "firm")
        plain = pick(f"Mail me: {user}@{host}.org", f"call our phone +49 30 {num(7)}", f"paid by card {card(' ')} today", f"login from host 10.{i % 250}.3.4")
        cue, span = pick(
            ("Please write to ", f"{user} at {host} dot com"), ("contact ", f"{user}[at]{host}[dot]net"), ("my e-mail: ", f"{user} (at) {host}.de"),
            ("credit card ", card(".")), ("visa ", card("/")), ("call our phone ", f"0049 {num(3)} {num(4)} {num(3)}"), ("tel ", f"{num(3)}-555-{num(4)}"),
            ("server address ", f"10[.]{i % 250}[.]7[.]9"), ("ip ", f"fe80::{num(3)}:{num(2)}"),
        )
        false = pick(f"invoice no. {num(4)}-{num(3)}-{num(4)}", f"order total {num(3)} {num(3)} {num(4)}", f"serial {num(4)}.{num(4)}.{num(4)}.{num(4)}", f"version {num(2)}.{num(3)}.{num(3)} build {num(3)} {num(4)} {num(3)}",
                     "meet at noon dot he said", f"from 2019 {num(4)} {num(4)} on")
        text = f"{plain}. Some words here. {cue}{span} thanks." + (f" See {false} there." if counter else "")
        at = text.index(span, text.index(cue))
        texts.append((i, text, "", "", 0))
        planted[i] = (at, at + len(span))
    return texts, planted


@pytest.mark.parametrize("counter", (True, False))
def test_pii_adds_disguised_spans(spark, counter):  # noqa: F811
    texts, planted = _planted(5, counter)
    df = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long")
    found, extra = 0, 0
    for r in pii.find_spans(df).collect():
        base = _base_spans(texts[r.doc_id][1])
        spans = [tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",")]
        added = set(spans) - {s[1:] for s in base}
        assert r.n_added == len(added) and {s[1:] for s in base} <= set(spans)
        hit = planted[r.doc_id] in added or any(s[1:] == planted[r.doc_id] for s in base)
        found, extra = found + hit, extra + len(added - {planted[r.doc_id]})
    assert found >= 0.9 * len(texts), (found, extra)
    assert extra <= 0.05 * len(texts), (found, extra)


def test_pii_em_against_loops():
    """The expectation-maximisation over patterns, one candidate at a time."""
    rng = np.random.default_rng(8)
    rows_ = []
    for _ in range(400):
        kind, real, base = int(rng.integers(4)), rng.random() < 0.6, rng.random() < 0.5
        votes = [1 if base else int(rng.choice([0, -1]))] + [int(rng.choice([1, 0, -1], p=[0.7, 0.2, 0.1] if real or base else [0.1, 0.3, 0.6])) for _ in range(5)]
        rows_.append((kind, tuple(votes)))
    patterns = [(k, pii._code(v), 0, n) for (k, v), n in __import__("collections").Counter(rows_).items()]
    p = [1.0 if v[0] > 0 else 1 / (1 + np.exp(-sum(v))) for _, v in rows_]
    for _ in range(50):
        says, prior = {}, {}
        for k in range(4):
            for side in (0, 1):
                for j in range(6):
                    yes = sum((q if side else 1 - q) for q, (kind, v) in zip(p, rows_) if kind == k and v[j] == 1)
                    no = sum((q if side else 1 - q) for q, (kind, v) in zip(p, rows_) if kind == k and v[j] == -1)
                    says[k, side, j] = (yes + 4 * (0.75 if side else 0.25)) / (yes + no + 4)
            free = [q for q, (kind, v) in zip(p, rows_) if kind == k and v[0] <= 0]
            prior[k] = (sum(free) + 1) / (len(free) + 2)
        p = []
        for k, v in rows_:
            up, down = prior[k], 1 - prior[k]
            for j, vote in enumerate(v):
                if vote:
                    up *= says[k, 1, j] if vote > 0 else 1 - says[k, 1, j]
                    down *= says[k, 0, j] if vote > 0 else 1 - says[k, 0, j]
            p.append(1.0 if v[0] > 0 else up / (up + down))
    model = pii.fit_patterns(patterns)
    assert all(abs(model.reliability[k, side, j] - r) < 1e-6 for (k, side, j), r in says.items())
    assert all(abs(model.prior[k] - q) < 1e-6 for k, q in prior.items())


def test_pii_adds_well_supported_spans(spark):  # noqa: F811
    good = [(i, f"please call our phone line {200 + i}-555-01{i % 90 + 10} today", "", "", 0) for i in range(60)]
    bad = [(100 + i, f"invoice order total no. {111}-111-1111 of version {i}", "", "", 0) for i in range(60)]
    sure = [(300 + i, f"mobile phone +49 30 {1000000 + i} or mail a{i}@example.org", "", "", 0) for i in range(60)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(good + bad + sure, schema)
    for some in (df, df.filter("doc_id < 100 or doc_id >= 300")):  # with and without counter-examples
        got = {r.doc_id: r for r in pii.find_spans(some).collect()}
        assert all(got[i].n_added == 1 for i in range(60))
        assert all(got[100 + i].n_added == 0 for i in range(60) if 100 + i in got)
        assert all(got[300 + i].n_phone == got[300 + i].n_email == 1 and got[300 + i].n_added == 0 for i in range(60))
    masked = {r.doc_id: r for r in pii.masked(df, pii.fit(df)).collect()}
    assert masked[300].text == "mobile phone <PHONE> or mail <EMAIL>" and masked[300].n_chars == len(masked[300].text)
    assert masked[0].text == "please call our phone line <PHONE> today"


def test_mix_is_exact_and_reruns_agree(spark, texts):  # noqa: F811
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = mixing.mix(docs).toPandas()
    assert (got.taken <= 2 * got["size"]).all() and (got.taken >= 0).all()
    sums = got.groupby("source", dropna=False).agg(target=("target", "first"), taken=("taken", "sum"), size=("source_size", "first"))
    assert (abs(sums.taken - sums.target) < 1.0001).all() and abs(sums.target.sum() - 1.5 * sums["size"].sum()) < 1e-6 * sums["size"].sum()
    # Filling by weight until none is above its stop, step by step.
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sums.index))}
    target, left, free = {}, 1.5 * sums["size"].sum(), set(sums.index)
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > 2 * sums["size"][s]}
        if not full:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: 2.0 * sums["size"][s] for s in full}
        left -= sum(target[s] for s in full)
        free -= full
    assert all(abs(target[s] - sums.target[s]) < 1e-6 * max(1, target[s]) for s in target)
    again = mixing.mix(docs.repartition(7), slice_docs=3).toPandas()
    key = ["doc_id", "taken", "position"]
    assert got[key].sort_values("doc_id").round(9).equals(again[key].sort_values("doc_id").round(9).set_axis(got.sort_values("doc_id").index))
    # Training rows: as many words as the mix takes, in order of position.
    train = mixing.training_rows(docs).toPandas()
    words = train.text.map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t)))
    assert words.groupby(train.doc_id).sum().to_dict() == got[got.taken > 0].set_index("doc_id").taken.to_dict()
    assert (train.n_chars == train.text.str.len()).all()


def test_mix_with_many_slices(spark):  # noqa: F811
    """More slices than a place of 52 bits can be multiplied by in a long."""
    n = 5000
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 7).cast("int")).alias("text"), F.lit("a").alias("source"))
    got = {r.doc_id: r.offered for r in mixing.plan_mix(df, slice_docs=1).collect()}
    want, words = {}, 0
    for i in sorted(range(n), key=lambda i: (int(hashlib.md5(str(i).encode()).hexdigest()[:13], 16), i)):
        want[i], words = words, words + i % 7
    assert got == want


def test_schedule_inverse(spark):  # noqa: F811
    for schedule in (*mixing.SCHEDULES, ((0.0, 0.0), (0.25, 1.0), (1.0, 0.0))):
        at = [i / 50 for i in range(51)]
        df = spark.createDataFrame([(a,) for a in at], "share double")
        got = [r[0] for r in df.select(mixing._inverse(F.col("share"), schedule)).collect()]
        grid = np.linspace(0, 1, 100_001)
        w = np.interp(grid, [t for t, _ in schedule], [v for _, v in schedule])
        cum = np.concatenate([[0], np.cumsum((w[1:] + w[:-1]) / 2)])
        assert np.allclose(np.interp(got, grid, cum / cum[-1]), at, atol=1e-4)


def test_fingerprint_query(spark, texts):  # noqa: F811
    got = {r.doc_id: r for r in QUERIES["op10_consistent_fingerprints"](spark, SF_SMALL).collect()}
    ids, seen = sorted(texts), {}
    for i, j in zip(ids, ids[1:] + ids[:1]):
        text, n = texts[i], len(texts[i]) // 4
        edited = text[: len(text) - n] + texts[j][:n]
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert seen.setdefault(text, got[i].fingerprint) == got[i].fingerprint
        assert 0 <= got[i].near_next <= 1 and 0 <= got[i].near_edited <= 1
    far = [r for r in got.values() if r.n_chars >= 500]
    assert np.mean([r.near_edited for r in far]) > 0.5 and np.mean([r.near_next for r in far]) < 0.1


def test_fingerprints_do_not_depend_on_company(texts, monkeypatch):
    some = list(texts.values())[:40] + ["", "a", "aaaa", "ab" * 500, ""]
    together = fingerprints.sketches(some)
    alone = np.concatenate([fingerprints.sketches([t]) for t in some])
    assert (together == alone).all()
    monkeypatch.setattr(fingerprints, "BLOCK", 1)
    assert (fingerprints.sketches(some) == alone).all()


def test_equal_substrings_share_phrases(texts):
    """Phrases inside a shared passage get equal names at any offset."""
    body = max(texts.values(), key=len)[:6000].encode()

    def names(prefix):
        x = np.frombuffer(b"\xff" + prefix + body + b"\xff", np.uint8).astype(np.uint64) + np.uint64(1)
        x[x == 256] = 0
        for _ in range(2):
            x = fingerprints._level(x)
        return set(x.tolist())

    own = names(b"")
    for prefix in (b"x", b"some other start ", b"zzzzzzz" * 9):
        assert len(own & names(prefix)) >= 0.95 * len(own)


def test_repeated_phrases_count_by_their_number(texts):
    line, other = "Some line that comes again and again.\n", max(texts.values(), key=len)
    text = line * 400
    own, changed, half, far = fingerprints.sketches([text, fingerprints.edited(text, other), line * 200, other])
    like = lambda a, b: float(fingerprints.likeness(a[None], b[None])[0])
    assert like(own, changed) > 0.2 and like(own, half) < 1 and like(own, far) < 0.1
    names = np.array([7, 5, 7, 7, 5, 7], np.uint64)
    assert fingerprints._occurrence(names, np.array([0, 0, 0, 1, 1, 1])).tolist() == [0, 0, 1, 0, 0, 1]


def test_one_document_follows_itself(spark):  # noqa: F811
    df = spark.createDataFrame([(5, "some words of one single document, nothing else")], "doc_id long, text string")
    (r,) = fingerprints.fingerprint_edits(df).collect()
    assert r.near_next == 1.0 and r.n_chars == 47


def test_top_k_against_all_products(spark):  # noqa: F811
    rng = np.random.default_rng(5)
    vectors = np.round(rng.normal(size=(700, 24)) * rng.lognormal(size=(700, 1)), 3).astype(np.float32)
    vectors[200:420] = vectors[200]  # many ties
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int").repartition(5)
    whole = np.floor(1024 * vectors.astype(np.float64)).astype(np.int64)
    want = []
    for q in range(0, 700, 100):
        scores = whole @ whole[q]
        order = sorted((i for i in range(700) if i != q), key=lambda i: (-scores[i], i))[:10]
        want += [(q, n + 1, i, int(scores[i])) for n, i in enumerate(order)]
    for rows_, head in ((topk.ROWS, topk.HEAD), (16, 24 * 4)):
        old = topk.ROWS, topk.HEAD
        topk.ROWS, topk.HEAD = rows_, head
        try:
            assert rows(topk.top_k(df)) == sorted(want, key=repr)
        finally:
            topk.ROWS, topk.HEAD = old


def test_licenses_against_plain_windows(spark, texts):  # noqa: F811
    got = {(r.doc_id, r.license) for r in license_scan.scan_licenses(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).collect()}
    scanner = license_scan.Scanner(license_scan.TEMPLATES)
    for i, text in texts.items():
        words = license_scan.words_of(text.encode())
        for name, exact in zip(scanner.names, scanner.exact):
            n = len(exact) + 4
            best = max((len({b" ".join(words[j : j + 5]) for j in range(a, min(a + n, len(words)) - 4)} & exact) for a in range(max(1, len(words) - n + 1))), default=0)
            if best / len(exact) >= 0.8:
                assert (i, name) in got, (i, name)


def test_licenses_are_found_in_windows_at_any_place():
    rng = np.random.default_rng(9)
    scanner = license_scan.Scanner(license_scan.TEMPLATES)
    noise = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 10**9, n))
    planted, texts_ = [], []
    for k in range(240):
        name, text = license_scan.TEMPLATES[k % len(license_scan.TEMPLATES)]
        texts_.append(f"{noise(int(rng.integers(0, 300)))} {text.upper()} {noise(int(rng.integers(0, 300)))}".encode())
        planted.append(name)
    texts_ += [noise(400).encode() for _ in range(100)] + [None, b""]
    found = {(d, scanner.names[t]) for d, t, *_ in scanner.scan(texts_)}
    assert sum((d, name) in found for d, name in enumerate(planted)) >= 239
    assert all(d < 240 for d, _ in found)
    for d, t, share, lo, hi in scanner.scan(texts_[:20]):
        assert share >= 0.8 and hi - lo >= len(scanner.exact[t])


def test_html_parts():
    page = """<html><head><title>T</title><style>p{}</style></head><body><header><h2>Site</h2></header>
    <nav><a href=x>Home</a></nav><div class="cookie-notice">We use cookies, ok?</div>
    <article><h1>Title &amp; more</h1><p>First  para,\n with <b>bold</b> text.<br>Line two.<p>Second para; it is &lt;long&gt;.
    <div class="ad">Buy now!</div><form><input value=x>Sign up<button>Go</button></form><script>var t="</p>";</script>
    <ul><li>one</li><li>two</li></ul><!-- <p>no</p> --></article>
    <aside>Side text, long enough to look like text.</aside><section id="comments"><p>Nice article, thanks a lot!</p></section>
    <footer>&copy; me</footer></body></html>"""
    assert html_text.main_text(page) == "Title & more\n\nFirst para, with bold text. Line two.\n\nSecond para; it is <long>.\n\none\n\ntwo"


def test_html_without_article():
    links = "".join(f"<li><a href='/{i}'>link {i}</a></li>" for i in range(12))
    body = "".join(f"<div class=row><p>Sentence number {i}, which is long enough; it has marks.</p></div>" for i in range(5))
    page = f"<body><div><ul>{links}</ul></div><div class=text>{body}</div><div><span>x</span></div></body>"
    got = html_text.main_text(page).split("\n\n")
    assert len([g for g in got if g.startswith("Sentence")]) == 5 and not any(g.startswith("link") for g in got)


@pytest.mark.parametrize(
    "text, license",
    (
        ("This work is licensed under the GNU General Public License, version 2", "GPL-2.0"),
        ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "GPL-2.0"),
        ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "GPL-3.0"),
        ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "AGPL-3.0"),
        ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "LGPL-3.0"),
        ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", "LGPL-2.1"),
        ("Licensed under CC BY 4.0", "CC-BY-4.0"),
        ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", "CC-BY-NC-SA-4.0"),
        (dict(license_scan.WORDINGS)["BSD-2-Clause-text"], "BSD-2-Clause"),
        (dict(license_scan.WORDINGS)["BSD-3-Clause-text-numbered"], "BSD-3-Clause"),
    ),
)
def test_sibling_licenses_are_told_apart(text, license):
    scanner = license_scan.Scanner(license_scan.WORDINGS)
    found = {license_scan.license_of(scanner.names[t]) for _, t, *_ in scanner.scan([f"a b c {text} d e f".encode()])}
    assert found == {license}


def test_every_wording_gives_its_license():
    scanner = license_scan.Scanner(license_scan.WORDINGS)
    found = {i: set() for i in range(len(license_scan.WORDINGS))}
    for d, t, *_ in scanner.scan([f"a b c {text} d e f".encode() for _, text in license_scan.WORDINGS]):
        found[d].add(license_scan.license_of(scanner.names[t]))
    assert {license_scan.WORDINGS[i][0]: v for i, v in found.items() if v != {license_scan.license_of(license_scan.WORDINGS[i][0])}} == {}


def test_licenses_side_by_side():
    by = dict(license_scan.WORDINGS)
    text = f"{by['LGPL-3.0-notice-program']} {by['GPL-3.0-notice']} {by['GPL-2.0-notice-program']}"
    scanner = license_scan.Scanner(license_scan.WORDINGS)
    found = {license_scan.license_of(scanner.names[t]) for _, t, *_ in scanner.scan([text.encode()])}
    assert found == {"LGPL-3.0", "GPL-3.0", "GPL-2.0"}


def _sentences(n):
    return [f"Sentence number {i} of the body, which is long enough to count; it has marks, and ends here." for i in range(n)]


def test_html_body_beside_teaser_articles():
    body = "".join(f"<p>{s}</p>" for s in _sentences(6))
    teasers = "".join(f"<article><h3><a href=/{i}>Teaser {i}</a></h3><p>{words}</p></article>" for i, words in enumerate(["Short words"] * 4 + ["Some more words of a teaser; it has marks, and is cut here."] * 4))
    got = html_text.main_text(f"<body><div class=text>{body}</div><div class=cards>{teasers}</div></body>").split("\n\n")
    assert [g for g in got if g.startswith("Sentence")] == _sentences(6)


def test_html_boilerplate_inside_main():
    body = "".join(f"<p>{s}</p>" for s in _sentences(6))
    links = "".join(f"<li><a href=/{i}>link {i}</a></li>" for i in range(8))
    cards = "".join(f"<div><span>Card {i}</span></div>" for i in range(8))
    page = f"<body><main><ul>{links}</ul><div class=text>{body}</div><ul>{links}</ul><div class=grid>{cards}</div></main></body>"
    assert html_text.main_text(page).split("\n\n") == _sentences(6)


@pytest.mark.parametrize("wrapper", ("<form id=aspnetForm><div>{}</div></form>", "<div class='site header-fixed'><article>{}</article></div>", "<div id=share><div>{}</div></div>"))
def test_html_body_in_a_named_wrapper(wrapper):
    body = "".join(f"<p>{s}</p>" for s in _sentences(6))
    page = f"<body><nav><a href=x>Home</a> and more</nav>{wrapper.format(body)}<footer>Some words, all rights reserved.</footer></body>"
    assert html_text.main_text(page).split("\n\n") == _sentences(6)


def test_html_comments_longer_than_the_article():
    body, talk = "".join(f"<p>{s}</p>" for s in _sentences(4)), "<p>A comment, long enough; it has marks, and goes on for a while here.</p>" * 12
    said = "<article>A comment, long enough; it has marks, and goes on for a while here.</article>" * 60
    assert html_text.main_text(f"<body><article>{body}</article><section id=comments>{said}</section></body>").split("\n\n") == _sentences(4)
    note = "<footer>Words of a footer, longer than the article; all rights reserved.</footer>"
    assert html_text.main_text(f"<body><article><p>A short text.</p></article>{note}</body>") == "A short text."
    for page in ("<body><article>{}</article><div id=comments>{}</div></body>", "<body><div>{}</div><div id=comments>{}</div></body>", "<body><main>{}<div id=comments>{}</div></main></body>"):
        assert html_text.main_text(page.format(body, talk)).split("\n\n") == _sentences(4)


def test_html_unbalanced_quotes():
    body = "".join(f"<p>{s}</p>" for s in _sentences(3))
    page = f"""<body><p class=foo">First "para" of it, long enough to count.</p><img alt=Bob's photo>{body}<p>It's the end, with words enough to count.</p><p title="a hidden > part">Last words, which are long enough to count.</p></body>"""
    want = ['First "para" of it, long enough to count.', *_sentences(3), "It's the end, with words enough to count.", "Last words, which are long enough to count."]
    assert html_text.main_text(page).split("\n\n") == want


def test_html_pages_of_the_table(spark):  # noqa: F811
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    for r in QUERIES["op2_html_tag_paths"](spark, SF_SMALL).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(p).split()) for p in re.split(r"</?(?:p|h1)>", re.sub(r"<br>|</?b>", " ", article))]
        assert r.text.split() == " ".join(p for p in parts if p).split() and r.n_chars == len(r.text)


def _learned(good, bad, n=120):
    """Held-out accuracy where each text has some of its label's words."""
    rng = np.random.default_rng(4)
    made = []
    for i in range(2 * n):
        own, y = (good, 1) if i % 2 else (bad, 0)
        words = [str(rng.choice(own)) for _ in range(6)] + [str(rng.choice(good + bad)) for _ in range(4)]
        made.append(("".join(rng.permutation(words)) if len(good[0]) == 1 else " ".join(rng.permutation(words)) + ".", y))
    rows_, y = [quality.features(t.encode()) for t, _ in made], np.array([y for _, y in made])
    model = quality.fit_rows(rows_[:n], y[:n])
    return np.mean([(model.score(r) >= 0.5) == c for r, c in zip(rows_[n:], y[n:])])


def test_quality_learns_words():
    """Labels that only the words tell: the shapes of all texts are alike."""
    assert _learned("scholar careful prose theorem archive library essay museum".split(), "casino winners bargain jackpot miracle lottery discount clickbt".split()) > 0.9


def test_quality_learns_scripts_without_spaces():
    assert _learned(list("学者慎重散文定理档案図書館"), list("賭場勝者特価奇跡彩票割引爆買")) > 0.9


def test_quality_features_of_pieces():
    """Blocks change nothing, and no text is without defined bins."""
    text = ("Mixed Text, naïve 日本語 words! " * 400).encode()
    whole, before = quality.features(text), quality.BLOCK
    try:
        quality.BLOCK = 101
        assert set(quality.features(text)) >= set(whole[whole >= quality._WORDS_AT])
    finally:
        quality.BLOCK = before
    assert len(quality.features(None)) == len(quality.features(b"")) == 0
    many = np.arange(0, quality.BINS, 3, dtype=np.int32)
    for bins in (whole, many, quality.features(None)):
        assert (quality._unpacked(quality._packed(bins)) == bins).all() and len(quality._packed(bins)) <= quality.BINS // 8 + 1


def test_a_hot_id_is_cut_into_ranges(spark):  # noqa: F811
    """A third of the rows without an id, a third with one id: ranges stay
    about equal, and the result is that of one range."""
    made = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text number {i} of many with some words {i * i}", "", "", 0) for i in range(900)]
    df = spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long")
    keyed = df.select("doc_id", "text").withColumn("order", F.xxhash64("text"))
    sizes = [r["count"] for r in fingerprints._ranges(keyed, 30)(keyed).groupBy("range").count().collect()]
    assert len(sizes) > 20 and max(sizes) < 4 * np.median(sizes)
    assert rows(fingerprints.fingerprint_edits(df, ranges=30)) == rows(fingerprints.fingerprint_edits(df, ranges=1))


def test_a_hot_id_is_cut_into_cells(spark):  # noqa: F811
    made = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, "w " * (i % 11), "", "a", i) for i in range(900)]
    df = spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long")
    got = mixing.plan_mix(df, slice_docs=50).toPandas()
    want, words = [], 0
    place = lambda i: int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:13], 16)
    ids = [None if i != i else int(i) for i in got.doc_id]
    for i in sorted(range(len(got)), key=lambda i: (place(ids[i]), ids[i] is not None, ids[i] or 0, got.row_hash[i])):
        want.append((i, words))
        words += int(got["size"][i])
    assert [int(got.offered[i]) for i, _ in want] == [w for _, w in want]


def _plain_hits(words, exact, n):
    """Windows of a template's length that hold at least 0.8 of its shingles."""
    out = []
    for a in range(max(1, len(words) - n - 3)):
        part = {b" ".join(words[j : j + 5]) for j in range(a, min(a + n, len(words) - 4))}
        if len(part & exact) >= 0.8 * len(exact):
            out.append((a, a + n + 4))
    return out


def test_notices_query_both_ways(spark, texts):  # noqa: F811
    """Over all wordings: each plain hit meets a reported notice, each notice
    is a plain hit, and no word belongs to two."""
    names = {n: i for i, (n, _) in enumerate(license_scan.NOTICES)}
    scanner = license_scan.Scanner(license_scan.NOTICES)
    found = {}
    for r in QUERIES["op3_license_scan"](spark, SF_SMALL).collect():
        assert r.license == license_scan.license_id(r.wording)
        found.setdefault(r.doc_id, []).append((r.first_word, r.end_word, r.wording, r.containment))
    assert found
    for i, text in texts.items():
        words = license_scan.words_of(text.encode())
        mine = sorted(found.get(i, []))
        assert all(a[1] <= b[0] for a, b in zip(mine, mine[1:]))
        grams = {b" ".join(words[j : j + 5]) for j in range(len(words) - 4)}
        for first, end, wording, share in mine:
            exact = scanner.exact[names[wording]]
            part = {b" ".join(words[j : j + 5]) for j in range(first, max(end - 4, first + 1))}
            assert share >= 0.8 and len(part & exact) > 0
        for exact, n in zip(scanner.exact, scanner.places):
            if len(exact & grams) >= 0.8 * len(exact):
                for a, b in _plain_hits(words, exact, n):
                    assert any(a < end and first < b for first, end, *_ in mine), (i, exact)


def test_one_row_per_notice():
    scanner = license_scan.Scanner(license_scan.NOTICES)
    known = {license_scan.license_id(n) for n, _ in license_scan.NOTICES}
    assert {"GPL-2.0-only", "GPL-2.0-or-later", "GPL-2.0", "MIT", "Apache-2.0"} <= known
    for name, text in license_scan.NOTICES:
        (row,) = scanner.passages([f"a b c {text} d e f".encode()])
        assert license_scan.license_id(scanner.names[row[1]]) == license_scan.license_id(name), name
        assert row[2] == 1.0 and (row[3], row[4]) == (3, 3 + len(license_scan.words_of(text.encode()))), name
    by = dict(license_scan.NOTICES)
    twice = f"{by['GPL-2.0-notice-program']} zz yy {by['GPL-2.0-notice-program']} x\n# SPDX-License-Identifier: MIT\n{by['Apache-2.0-notice']}"
    got = [license_scan.license_id(scanner.names[t]) for _, t, *_ in sorted(scanner.passages([twice.encode()]), key=lambda r: r[3])]
    assert got == ["GPL-2.0-or-later", "GPL-2.0-or-later", "MIT", "Apache-2.0"]
    assert scanner.passages([None, b"", b"a b", b"no license at all in these words"]) == []


def test_license_short_wordings_are_only_sought_at_their_first_word(monkeypatch):
    class Words(list):
        slices = 0

        def __getitem__(self, at):
            Words.slices += isinstance(at, slice)
            return super().__getitem__(at)

    split = license_scan.words_of
    monkeypatch.setattr(license_scan, "words_of", lambda text: Words(split(text)))
    scanner = license_scan.Scanner(license_scan.NOTICES)
    assert len(scanner.short) == 5
    text = b" ".join(b"w%d" % i for i in range(3000))
    Words.slices = 0
    assert scanner.passages([text]) == [] and Words.slices < 100  # five for each word before
    tag = b"SPDX-License-Identifier: MIT"
    rows = scanner.passages([text + b" " + tag + b" end spdx " + tag, tag])
    assert [(d, scanner.names[t], *r) for d, t, *r in rows] == [
        (0, "MIT-tag", 1.0, 3000, 3004), (0, "MIT-tag", 1.0, 3006, 3010), (1, "MIT-tag", 1.0, 0, 4),
    ]


def test_license_windows_have_the_least_value_of_their_shingles(monkeypatch):
    monkeypatch.setattr(license_scan, "PLACES", 7)
    scanner = license_scan.Scanner(license_scan.WORDINGS)
    seen = {}
    monkeypatch.setattr(license_scan._Class, "retrieve", lambda c, k, value: seen.update({(c.units, k): value.tolist()}) or iter(()))
    texts_ = [b" ".join(b"w%d" % (i * j) for i in range(n)) for j, n in ((3, 700), (5, 3), (7, 9), (11, 260), (13, 0), (17, 5))]
    scanner.passages(texts_)
    hashes = [license_scan.shingle_hashes(w) for w in map(license_scan.words_of, texts_) if len(w) >= scanner.words]
    for c in scanner.classes:
        step = c.units * license_scan.UNIT
        for k in range(0, c.bands, 9):
            want = [int(scanner._permuted(h[a : a + 2 * step], k).min()) for h in hashes for a in range(0, len(h), step)]
            assert seen[c.units, k] == want


def test_fingerprints_take_few_rows_out_of_a_batch_at_once(monkeypatch):
    import pyarrow as pa

    most = []
    plain = fingerprints.sketches
    monkeypatch.setattr(fingerprints, "sketches", lambda some: most.append(len(some)) or plain(some))
    n = 1000
    batch = pa.RecordBatch.from_arrays([pa.array([False] * n), pa.array(range(n)), pa.array([f"text {i % 7} of it" for i in range(n)])], ["last", "doc_id", "text"])
    got = [r for b in fingerprints._in_order(iter([batch])) for r in b.to_pylist()]
    assert [r["doc_id"] for r in got] == list(range(n - 1)) and max(most) <= 300
    # Whatever the rows come in, the results are the same.
    again = [r for b in fingerprints._in_order(batch.slice(i, 90) for i in range(0, n, 90)) for r in b.to_pylist()]
    assert got == again


def test_edited_notices_near_the_limit_are_found():
    """Recall where only 0.8 to 0.9 of the shingles are left."""
    rng = np.random.default_rng(6)
    scanner = license_scan.Scanner(license_scan.NOTICES)
    texts_, wanted = [], []
    long = [(n, license_scan.words_of(t.encode())) for n, t in license_scan.NOTICES]
    long = [(n, w) for n, w in long if len(w) >= 30]
    while len(texts_) < 300:
        name, words = long[int(rng.integers(len(long)))]
        edited = list(words)
        for _ in range(int(rng.integers(1, 4))):
            edited[int(rng.integers(len(edited)))] = b"changed%d" % rng.integers(10**6)
        exact = scanner.exact[scanner.names.index(name)]
        share = len({b" ".join(edited[i : i + 5]) for i in range(len(edited) - 4)} & exact) / len(exact)
        if 0.8 <= share < 0.9:
            noise = [b"w%d" % x for x in rng.integers(0, 10**9, int(rng.integers(0, 200)))]
            texts_.append(b" ".join([*noise, *edited, *noise]))
            wanted.append((len(noise), len(noise) + len(edited)))
    found = {}
    for d, _, share, a, b in scanner.passages(texts_):
        found.setdefault(d, []).append((a, b))
    assert sum(any(a < e and f < b for a, b in found.get(d, [])) for d, (f, e) in enumerate(wanted)) >= 0.99 * len(wanted)


_LONG = "The quick brown fox, as we know, jumps over the lazy dog; it does so again. " * 4


def test_html_names_of_the_article_stay():
    """Tokens that hold a telling word beside words of the article's own."""
    page = f"""<body><nav class=main-nav><a href=x>Home</a></nav><article><h1>Title of it</h1><p>{_LONG}</p>
    <section id='side-effects'><h2>Side effects</h2><p>{_LONG}B</p></section><section id='related-work'><p>{_LONG}C</p></section>
    <p class='notice-period'>{_LONG}D</p><div class='related-posts'><p>{_LONG}E</p></div><div class=sidebarLeft><p>{_LONG}F</p></div></article></body>"""
    got = html_text.main_text(page).split("\n\n")
    assert got == ["Title of it", _LONG.strip(), "Side effects", f"{_LONG}B", f"{_LONG}C", f"{_LONG}D"]


def test_html_short_blocks_between_paragraphs_stay():
    page = f"""<body><ul><li><a href=1>one</a></li><li><a href=2>two</a></li></ul><article><p>{_LONG}</p><ul><li>flour</li><li>two eggs</li></ul>
    <p>{_LONG}</p><div><a href=x>A linked paragraph inside</a></div><div>Subscribe to our letter</div><p>{_LONG}</p></article><div>end</div></body>"""
    assert html_text.main_text(page).split("\n\n") == [_LONG.strip(), "flour", "two eggs", _LONG.strip(), "A linked paragraph inside", _LONG.strip()]


def test_html_deep_pages_take_linear_time():
    import time

    for piece in ("<div>x<p>", "<div class=nav>text ", "<div>x</span>", "<div><article>y "):
        start = time.process_time()
        assert html_text.main_text(piece * 20_000)
        assert time.process_time() - start < 15, piece
