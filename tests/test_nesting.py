"""Depth of JSON text, and what becomes of lines that are nested too deep."""

import json
import random

import pytest
from pyspark.sql import functions as F

from turnmill.config import TokenLimits
from turnmill.functions import messages as ms
from turnmill.functions.nesting import MAX_DEPTH, PARSER_DEPTH, nesting_fault
from turnmill.plans import audits, curate, profile
from turnmill.sources import jsonl

LEVELS = [MAX_DEPTH + 1, 2000, 20_000, 100_000]


def nested(levels):
    return "[" * levels + "]" * levels


def hostile():
    objects = '{"a":' * 5000 + "1" + "}" * 5000
    mixed = '[{"a":[' * 3000 + "]}]" * 3000
    late = "[" + '{"role":"user","content":"x"},' * 400 + nested(2000) + "]"
    pairs = "[[]," * 50_000
    return [nested(n) for n in LEVELS] + [objects, mixed, late, "[" * 100_000, pairs, '{"a":[' * 40_000]


def plain_fault(raw, most):
    """By a counter, strings passed over, up to a bracket that closes nothing."""
    depth = deepest = 0
    inside = escaped = False
    for c in raw:
        if inside:
            inside, escaped = (c != '"' or escaped), (c == "\\" and not escaped)
        elif c == '"':
            inside = True
        elif c in "[{":
            depth += 1
            deepest = max(deepest, depth)
        elif c in "]}":
            depth -= 1
            if depth < 0:
                break
    return deepest > most


def test_measure_equals_a_counter(spark):
    draw, texts = random.Random(3), []
    for _ in range(600):
        levels = draw.randint(0, 9)
        body = "".join(draw.choice(['[', ']', '{', '}', '"[[["', '"]\\"]"', "1,", '"\\\\"']) for _ in range(draw.randint(0, 40)))
        texts += ["[" * levels + '"]]]["' + "]" * levels, "[[" + "[],{}," * levels + "[[]]]]", body]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    for most in (1, 3, 6):
        got = dict(rows.select("i", nesting_fault(F.col("t"), most)).collect())
        for i, text in enumerate(texts):
            try:
                json.loads(text)
            except ValueError:
                # No JSON; all that matters is that a deep text does not get to the parser.
                assert got[i] is not None or not plain_fault(text, most)
            else:
                assert got[i] == ("too_deep" if plain_fault(text, most) else None)


def test_texts_up_to_the_limit_are_parsed(spark):
    rows = [(nested(PARSER_DEPTH),), ('["' + "[" * 9000 + '"]',), ('["a\\\\",' + '"]{",' * 3000 + "1]",), ("[" * 1300 + "]" * 1299,)]
    got = spark.createDataFrame(rows, "t string").select(ms.parse_json(F.col("t")).isNotNull(), nesting_fault(F.col("t"), PARSER_DEPTH))
    assert [tuple(r) for r in got.collect()] == [(True, None), (True, None), (True, None), (False, "too_deep")]
    none = spark.createDataFrame([(None,), ("",)], "t string").select(nesting_fault(F.col("t"), PARSER_DEPTH)).collect()
    assert [r[0] for r in none] == [None, None]


GOOD = json.dumps([{"role": "user", "content": "q"}, {"role": "assistant", "content": "r"}])


def test_audit_normalising_profile_and_curation(spark):
    """Deep lines have an outcome of their own, others their usual one, and the session lives on."""
    lines = hostile() + [nested(MAX_DEPTH), "[" * 400, GOOD]
    numbered = spark.createDataFrame([("a", k, line) for k, line in enumerate(lines)], "corpus string, line_no bigint, line string")
    codes = {r["line_no"]: r["code"] for r in audits.audit_numbered(numbered).collect()}
    n = len(hostile())
    assert [codes[k] for k in range(n + 3)] == ["too_deep"] * n + ["too_few", "invalid_json", "valid"]
    raw = numbered.select(F.col("line_no").alias("id"), F.lit("t").alias("tier"), F.col("line").alias("messages"))
    inspected = raw.withColumn("i", ms.inspect_json(ms.elements(ms.parse_json(F.col("messages")))))
    normal = ms.normalize(inspected, "i", "m").select(F.col("m").isNotNull()).collect()
    assert [r[0] for r in normal] == [False] * (n + 2) + [True]
    measured = profile.measured_rows(raw).select("n_messages", "too_deep").collect()
    assert [tuple(r) for r in measured] == [(None, True)] * n + [(1, False), (None, False), (2, False)]
    quotas = spark.createDataFrame([("t", 0, "other", 100)], "tier string, tier_no int, rule string, target bigint")
    made = curate.curate_rows(raw, quotas)
    outcomes = {r["id"]: r["outcome"] for r in made.verdicts.collect()}
    assert [outcomes[k] for k in range(n)] == ["too_deep"] * n
    assert {outcomes[n], outcomes[n + 1]} == {"normalize_failed"}
    assert made.corpus.count() == sum(o == "accepted" for o in outcomes.values())
    assert spark.range(3).count() == 3


def test_counting_and_prompts_stop_with_that_outcome(spark, tmp_path):
    for levels in LEVELS:
        path = tmp_path / f"{levels}.jsonl"
        path.write_text(GOOD + "\n" + nested(levels) + "\n")
        for job in (
            lambda: audits.count_read(jsonl.read_lines(spark, str(path)), lambda t: F.length(t)),
            lambda: audits.filter_files(spark, str(path), lambda t: F.length(t), TokenLimits(max=10)),
            lambda: jsonl.read_prompts(spark, str(path)).collect(),
        ):
            with pytest.raises(Exception, match="too_deep"):
                job()
        assert path.read_text().startswith(GOOD)
    assert spark.range(3).count() == 3
