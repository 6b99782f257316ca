import pytest

from turnmill.plans import profile, scoring


def _responses(spark, rows):
    return spark.createDataFrame(
        rows, "prompt_id bigint, prompt string, response string, seconds double"
    )


ROWS = [
    (1, "สวัสดี", "ครับ", 1.234),
    (2, "สวัสดี", "hello", 2.0),
    (3, "hello", "hi", 3.0),
    (4, "hello", "ครับ", 4.0),
    (5, "hello กก", "ok", 0.0),
]


def test_scores_and_summary(spark):
    scored = scoring.score_responses(_responses(spark, ROWS))
    first = scored.filter("prompt_id = 1").first()
    assert first["is_target_prompt"] and first["is_target_response"]
    assert (first["n_chars"], first["time_seconds"]) == (4, 1.23)
    r = scoring.score_summary(scored).first()
    assert (r["n_prompts"], r["n_target_prompts"], r["n_other_prompts"]) == (5, 3, 2)
    assert (r["target_kept"], r["other_kept"], r["n_target_responses"]) == (1, 1, 2)
    assert r["pct_target_kept"] == pytest.approx(100 / 3) and r["pct_other_kept"] == 50.0
    assert r["mean_seconds"] == pytest.approx(2.0468)


def test_summary_of_nothing(spark):
    r = scoring.score_summary(scoring.score_responses(_responses(spark, []))).first()
    assert r["n_prompts"] == 0
    assert r["pct_target_kept"] is None and r["mean_seconds"] is None


def test_comparison_keeps_prompts_of_either_run(spark):
    base = scoring.score_responses(_responses(spark, ROWS[:3]))
    adapted = scoring.score_responses(
        _responses(spark, [(2, "สวัสดี", "ครับผม", 2.5), (3, "hello", "ครับ", 1.0), (9, "x", "y", 1.0)])
    )
    compared = scoring.compare(base, adapted)
    got = {r["prompt_id"]: r for r in compared.collect()}
    assert {p: r["present"] for p, r in got.items()} == {
        1: "base_only", 2: "both", 3: "both", 9: "adapted_only",
    }
    assert (got[2]["base_kept"], got[2]["adapted_kept"], got[2]["n_chars_delta"]) == (False, True, 1)
    summary = {r["present"]: r for r in scoring.compare_summary(compared).collect()}
    assert (summary["both"]["gained"], summary["both"]["lost"]) == (1, 1)


def test_prompts_are_trimmed(spark):
    df = spark.createDataFrame([(" a\n",), (" 　",), ("",), (None,)], "prompt string")
    assert [r[0] for r in scoring.usable_prompts(df).collect()] == ["a"]


def test_profile_of_rows_without_a_source_column(spark):
    rows = [('[{"content":"ก"},{"content":"b"}]',), ("plain ก",), ("{}",)]
    df = spark.createDataFrame(rows, "messages string")
    measured = profile.measured_rows(df)
    got = [(r["n_messages"], r["has_script"]) for r in measured.collect()]
    assert sorted(got, key=str) == [(2, True), (None, False), (None, True)]
    share = profile.script_share_by_source(measured).first()
    assert (share["source"], share["n_rows"], share["n_script"]) == ("unknown", 3, 2)
    named = measured.selectExpr("*", "cast(null as string) as source")
    assert profile.script_share_by_source(named).first()["source"] is None
