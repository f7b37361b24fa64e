"""Plan-shape guards: the properties the design relies on at scale."""

import pytest

import __spark_entry__ as E
from logsentinel.plans.catalog import REGISTRY
from tests.conftest import SF_SMALL

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
             "BroadcastNestedLoopJoin")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_python_workers_or_cross_joins(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    for node in FORBIDDEN:
        assert node not in plan, f"{name}: {node} in plan"


def test_top_ips_is_a_top_k_over_a_partial_aggregate(spark):
    df = E.queries()["top_malicious_ips"](spark, SF_SMALL)
    plan = _plan(df)
    assert "TakeOrderedAndProject" in plan and "partial_count" in plan
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,value:double>" in plan  # 3 of 6 columns read


def test_sqli_xss_totals_scans_once(spark):
    plan = _plan(E.queries()["sqli_xss_totals"](spark, SF_SMALL))
    assert plan.count("FileScan parquet") == 1


def test_port_scan_uses_two_level_distinct_aggregate(spark):
    plan = _plan(E.queries()["port_scan"](spark, SF_SMALL))
    assert "partial_count(distinct" in plan


def test_sliding_window_filters_before_expand(spark):
    plan = _plan(E.queries()["brute_force_sliding"](spark, SF_SMALL))
    below_expand = plan[plan.index("Expand"):]  # tree text: children come after their parent
    assert "Filter" in below_expand and "error" in below_expand  # the action filter (error -> failed)


def test_reputation_uses_scalar_subqueries_not_joins(spark):
    plan = _plan(E.queries()["ip_reputation"](spark, SF_SMALL))
    assert "Subquery" in plan and "Join" not in plan


def test_scalar_statistics_run_once_per_table(spark):
    from tools.plan_report import summarize

    def run(name):
        df = E.queries()[name](spark, SF_SMALL)
        df.write.format("noop").mode("overwrite").save()
        return summarize(df)

    rep = run("ip_reputation")  # one min/max subquery + the table itself
    assert rep["names"]["_scan"] == 2 and rep["shuffles"]["single"] == 1
    kpis = run("threat_kpis")  # three tables + the one-row base
    assert kpis["names"]["_scan"] == 4


def test_batch_summary_is_one_scan_one_shuffle(spark):
    from logsentinel.operators import batch
    from logsentinel.sources import adapters
    from tools.plan_report import summarize

    df = batch.batch_summary(adapters.load_log_view(spark, SF_SMALL))
    df.write.format("noop").mode("overwrite").save()
    s = summarize(df)
    assert s["names"]["_scan"] == 1 and s["shuffles"]["hash"] == 1 and s["names"]["Expand"] == 1


DECODED = ("brute_force_sliding", "attack_signatures_sliding", "signature_match", "volume_sliding")


@pytest.mark.parametrize("name", DECODED)
def test_each_line_is_parsed_once(spark, name):
    from logsentinel.operators import detect
    from logsentinel.sources import adapters, readers

    lines = adapters.to_json_lines(adapters.load_log_view(spark, SF_SMALL))
    plan = getattr(detect, name)(readers.decode_log_json(lines, broker_time_col=None, watermark=None))
    assert _plan(plan).count("from_json") == 1


@pytest.mark.parametrize("name", DECODED)
def test_each_line_is_parsed_once_in_a_stream(spark, tmp_path, name):
    from logsentinel.operators import detect
    from logsentinel.sources import adapters
    from logsentinel.streaming import runner

    adapters.to_json_lines(adapters.load_log_view(spark, SF_SMALL)).write.text(str(tmp_path / "in"))
    q = runner.start_detector(
        runner.text_file_source(spark, str(tmp_path / "in")), getattr(detect, name), str(tmp_path / "ckpt"),
        "append" if name == "signature_match" else "update", sink=lambda df, i: df.count(), trigger={"availableNow": True})
    runner.await_all([q])
    plan = q._jsq.query().toString() if not hasattr(q._jsq, "explainInternal") else q._jsq.explainInternal(False)
    assert plan.count("from_json") == 1, plan


def test_lookup_cuts_the_alerts_to_the_requested_addresses_first(spark):
    from logsentinel.plans import catalog

    plan = _plan(E.queries()["ip_lookup"](spark, SF_SMALL))
    below = plan[plan.index("max_by"):]
    assert "LeftSemi" in below


def test_hot_scores_are_spread_by_further_sort_keys(spark):
    feed, score = (_plan(E.queries()[n](spark, SF_SMALL)) for n in ("alert_feed", "threat_score_by_ip"))
    assert "threat_score" in feed and "window_start" in feed[feed.index("rangepartitioning"):].split("\n")[0]
    assert "source_ip" in score[score.index("rangepartitioning"):].split("\n")[0]
