"""The pipeline against its stages done by hand, and the SQL oracles."""

import collections
import hashlib
import re

import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline
from logsentinel.llm import mixing, pii, quality, simhash
from logsentinel.llm.oracle import ORACLE
from logsentinel.llm.queries import QUERIES, tokenizer_path
from tests.conftest import SF_SMALL, spark  # noqa: F401
from tools.parity import compare, duck


def test_stages_one_by_one(spark):  # noqa: F811
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, now = docs.columns, docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF_SMALL)
        assert now.columns == columns
        seen[name] = now = now.cache()
    before = {r.doc_id: r for r in docs.collect()}
    good = {r.doc_id for r in quality.score(docs, quality.fit(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))).collect() if r.predicted}
    assert {r.doc_id for r in seen["quality"].collect()} == good
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(seen["quality"]).collect()}
    assert sorted(r.doc_id for r in seen["near_duplicates"].collect()) == sorted({c for c in groups.values()})
    masked = {r.doc_id: r.text for r in seen["personal_data"].collect()}
    assert set(masked) == set(groups.values())
    for i, text in masked.items():
        base = pii.candidates(before[i].text)[0]
        assert (text == before[i].text) == (not base) and not pii.candidates(text)[0]
    take = {r.doc_id: r.taken for r in mixing.mix(seen["personal_data"]).collect()}
    words = collections.Counter()
    for r in seen["mixing"].collect():
        words[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        assert masked[r.doc_id].startswith(r.text)
    assert dict(words) == {i: n for i, n in take.items() if n}


def test_run_gives_the_last_stage(spark):  # noqa: F811
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    got = QUERIES["pipeline"](spark, SF_SMALL).collect()
    assert got
    for r in got[:200]:
        ids = np.frombuffer(bytes(r.ids), "<u4")
        text = library.decode(ids.tolist(), skip_special_tokens=False)
        assert r.n_tokens == len(ids) and library.encode(text, add_special_tokens=False).ids == ids.tolist()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", ORACLE)
def test_query_matches_oracle(spark, name):  # noqa: F811
    r = compare(spark, name, SF_SMALL, duck(SF_SMALL))
    assert r["status"] == "ok", r


def test_registered():
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "personal_data", "mixing", "encoding"]


def test_only_the_last_stage_table_stays(spark):  # noqa: F811
    import os

    from logsentinel.session import shared_path

    folder = shared_path(spark, "llm").removeprefix("file:")
    stages = lambda: {n: set(os.listdir(f"{folder}/{n}")) for n in os.listdir(folder) if n.startswith("stage_")}
    before = stages() if os.path.isdir(folder) else {}
    assert QUERIES["pipeline"](spark, SF_SMALL).count() > 0
    new = {n: len(kept - before.get(n, set())) for n, kept in stages().items()}
    assert new == {"stage_quality": 0, "stage_near_duplicates": 0, "stage_personal_data": 0, "stage_mixing": 1}


def test_stages_leave_no_tables_of_their_operators(spark):  # noqa: F811
    import os

    from logsentinel.llm.common import scratch
    from logsentinel.session import shared_path

    folder = shared_path(spark, "llm").removeprefix("file:")
    tables = lambda: {f"{n}/{t}" for n in os.listdir(folder) for t in os.listdir(f"{folder}/{n}")} if os.path.isdir(folder) else set()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    before = tables()
    with scratch(spark):
        assert simhash.keep_one(docs).count() and mixing.training_rows(docs).count()
        assert len(tables() - before) > 3
    assert tables() == before
