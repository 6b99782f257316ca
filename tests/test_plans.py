"""Plans, not results: what is pushed down, what is shuffled, where everything would meet."""

import re

import pytest

from registry import inputs as src
from registry.queries import QUERIES
from turnmill.functions.line_audit import audit_line
from turnmill.operators.turns import conversation_facts
from turnmill.plans import curate, profile


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def middle(small):
    return small.replace("sf0.001", "sf0.01")


def test_ids_of_the_first_rows_bound_the_scan(spark, middle):
    plan = plan_of(profile.first_conversations(src.turns(spark, middle), 10))
    assert re.search(r"PushedFilters: \[[^]]*LessThanOrEqual\(conv_id", plan)


def test_narrow_queries_read_narrow_columns(spark, middle):
    plan = plan_of(QUERIES["turn_stats"](spark, middle))
    assert "ReadSchema: struct<conv_id:bigint>" in plan
    plan = plan_of(QUERIES["script_share_first_n"](spark, middle))
    assert "role" not in plan


def test_text_stops_at_the_scan(spark, middle):
    """Facts shuffle numbers only."""
    facts = conversation_facts(src.turns(spark, middle), src.ACCENTED)
    plan = plan_of(facts)
    above_first_exchange = plan[: plan.rindex("Exchange")]
    assert "text#" not in above_first_exchange
    assert plan.count("Exchange hashpartitioning") == 2


# Queries that end in one row per table, tier, class or file may bring those rows together.
FULL_TABLE = [
    "script_stats", "conversation_text", "exchange_text", "normalized_conversations",
    "normalize_json", "conversation_measures", "dedup_documents", "dedup_first_prompt",
    "scanned_rows", "train_eval_split", "curated_corpus", "curated_rows", "format_audit_lines",
    "token_filter", "token_over_limit", "eval_scores", "ab_comparison", "packing_plan",
]


@pytest.mark.parametrize("name", FULL_TABLE)
def test_rows_never_meet_in_one_partition(name, spark, middle):
    """A single partition is only ever fed by a partial aggregate, or by the rows of the one key
    prefix (of 65,536) that holds a cutoff."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = QUERIES[name](spark, middle)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = plan_of(df)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plan.splitlines()
    for at, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            fed_by = " ".join(lines[at + 1 : at + 3])
            assert "HashAggregate" in lines[at + 1] or "[prefix" in fed_by, fed_by[:600]
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_results_do_not_depend_on_partitions(spark, middle):
    turns = src.turns(spark, middle)
    results = []
    for n in (1, 4, 37):
        facts = conversation_facts(turns.repartition(n), src.ACCENTED, segment=3)
        results.append(sorted(tuple(r) for r in facts.collect()))
    assert results[0] == results[1] == results[2]


def test_curated_corpus_passes_its_audit(spark, middle):
    rows = QUERIES["jsonl_roundtrip"](spark, middle).collect()
    assert rows and all(r["code"] == "valid" for r in rows)
    assert all(r["first_line"] == 1 and r["last_line"] == r["n_lines"] for r in rows)


def test_a_line_is_parsed_once(spark, middle):
    """The audit of a line holds one JSON parse, of which every check reads."""
    audited = audit_line(src.numbered_lines(spark, middle), "line", src.ACCENTED)
    assert plan_of(audited).count("from_json(") == 1


def test_turns_past_the_cutoff_go_before_their_text_is_shuffled(spark, middle, monkeypatch):
    plans = []
    kept = curate.materialize
    monkeypatch.setattr(
        curate, "materialize", lambda df, name: (plans.append((name, plan_of(df))), kept(df, name))[1]
    )
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        QUERIES["curated_corpus"](spark, middle)
        QUERIES["curated_rows"](spark, middle)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    for plan in (plan for name, plan in plans if name == "unique"):
        scan = plan.rindex("FileScan parquet [conv_id")
        shuffles = [m.start() for m in re.finditer("Exchange hashpartitioning", plan)]
        cut = plan.rindex("md5(")
        assert "cut#" in plan and cut < scan
        assert [at for at in shuffles if at < cut]  # the shuffle of texts stands above the cut


def test_curation_takes_few_jobs(spark, middle):
    tracker, group = spark.sparkContext.statusTracker(), "curation-jobs"
    spark.sparkContext.setJobGroup(group, group)
    try:
        QUERIES["curated_corpus"](spark, middle).collect()
        n_jobs = len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert n_jobs <= 40
