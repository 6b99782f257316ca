import json
import random

import pytest
from pyspark.sql import functions as F

from reference_rules import NBSP_BLANK, measures, normal_form
from turnmill.config import THAI, Limits, Script
from turnmill.functions import messages as ms
from turnmill.functions.verdict import measures_of, other_reason, target_reason
from turnmill.operators.turns import assemble, conversation_facts, normalized_turns, openings


def message(role):
    return lambda content, **more: {"role": role, "content": content, **more}


U, A, S, T = (message(r) for r in ("user", "assistant", "system", "tool"))

# name: (input, expected (role, content) pairs or None)
CASES = {
    "n01": ([U("q"), A("r")], [("user", "q"), ("assistant", "r")]),
    "n02": ([S("s"), U("q"), A("r")], [("user", "s\n\nq"), ("assistant", "r")]),
    "n03": ([S("s1"), S("s2"), U("q"), A("r")], [("user", "s2\n\nq"), ("assistant", "r")]),
    "n04": ([U("q"), S("s"), A("r")], [("user", "q"), ("assistant", "r")]),
    "n05": ([S("  "), U("q"), A("r")], [("user", "q"), ("assistant", "r")]),
    "n06": ([U("q"), A("", tool_calls=[{"id": 1}])], None),
    "n07": ([U("q"), A("r", tool_calls=[{"id": 1}])], [("user", "q"), ("assistant", "r")]),
    "n08": ([U("q"), T("t"), A("r")], [("user", "q"), ("assistant", "r")]),
    "n09": ([U("q"), A("r"), U("q")], None),
    "n10": ([U("q"), U("q"), A("r")], None),
    "n11": ([A("r"), U("q"), A("r")], None),
    "n12": ([U("q"), A(" "), U("q2"), A("r")], None),
    "n13": (["a", "b"], None),
    "n14": ([U("q"), "b", A("r")], None),
    "n15": ({"role": "user", "content": "q"}, None),
    "n16": ([], None),
    "n17": ([U("q")], None),
    "n18": ([U(5), U("x"), A("r")], [("user", "x"), ("assistant", "r")]),
    "n19": ([U("q"), A(None, tool_calls=[]), A("hi")], [("user", "q"), ("assistant", "hi")]),
    "n20": ([U(NBSP_BLANK), U("x"), A("r")], [("user", "x"), ("assistant", "r")]),
    "n21": ([S("s"), T("t"), S("s2"), U("q"), A("r")], [("user", "s2\n\nq"), ("assistant", "r")]),
    "n22": ([U("", tool_calls=[1]), U("x"), A("r")], [("user", "x"), ("assistant", "r")]),
    "n23": ([{"content": "orphan"}, U("q"), A("r")], [("user", "q"), ("assistant", "r")]),
    "n24": ("not json", None),
    "n25": (None, None),
}
FALSY_CALLS = [None, False, 0, 0.0, "", [], {}]
TRUTHY_CALLS = [True, 1, 0.5, "0", "false", [0], {"a": None}]


def _normalized_json(spark, rows):
    df = spark.createDataFrame(rows, "name string, raw string")
    inspected = ms.inspect_json(ms.elements(ms.parse_json(F.col("raw"))))
    out = ms.normalize(df.withColumn("_i", inspected), "_i").collect()
    return {
        r["name"]: None if r["messages"] is None else [tuple(m) for m in r["messages"]]
        for r in out
    }


def test_json_cases(spark):
    rows = [
        (name, raw if raw is None or isinstance(raw, str) else json.dumps(raw))
        for name, (raw, _) in CASES.items()
    ]
    got = _normalized_json(spark, rows)
    for name, (raw, expected) in CASES.items():
        assert got[name] == expected, name
        assert normal_form(raw) == expected, name


def test_tool_calls_truth(spark):
    rows = [
        (f"{kind}{i}", json.dumps([U("q"), A("", tool_calls=value), A("r")]))
        for kind, values in (("falsy", FALSY_CALLS), ("truthy", TRUTHY_CALLS))
        for i, value in enumerate(values)
    ]
    for name, got in _normalized_json(spark, rows).items():
        assert (got is None) == name.startswith("truthy"), name


def test_what_counts_as_a_json_document(spark):
    """As Python's own parser has it."""
    cases = [
        "[1]", " [1] ", '{"a":1}', "5", "null", '"x"', "NaN", "-Infinity", "[]", "1.5e3", "[NaN]",
        "", " ", "[1] [2]", "[1],[2]", '{"a":1} xyz', "[1]], [", "1], [2", "[1,]", "[1,2", "nul",
        "{'a':1}", '"x', "01", "// c\n1", "[1]\u00a0", "\ufeff[1]", "[1],2,[3", "], [", '["\t"]',
    ]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, raw string")
    got = df.orderBy("i").select(ms.parse_json(F.col("raw")).isNotNull()).collect()
    for case, row in zip(cases, got):
        try:
            json.loads(case)
            valid = True
        except ValueError:
            valid = False
        assert row[0] == valid, case


def test_very_long_texts_are_parsed_whole(spark):
    raw = F.concat(F.lit('[{"content":"'), F.repeat(F.lit("x" * 1024), 24 * 1024), F.lit('"}]'))
    document = ms.parse_json(F.col("raw"))
    text = ms.conversation_text(document, F.lit("not read"))
    row = spark.range(1).select(raw.alias("raw")).select(F.length(text)).first()
    assert row[0] == 24 * 1024 * 1024


def test_last_of_equal_json_keys_wins(spark):
    raw = '[{"role":"system","role":"user","content":"q"},{"role":"assistant","content":"r"}]'
    assert _normalized_json(spark, [("x", raw)])["x"] == [("user", "q"), ("assistant", "r")]


def test_validator_cases(spark):
    k = "ก"
    cases = [
        ("hello", "world", "no_thai", "ok"),
        (k + "a" * 8, "b" * 10, "ok", "has_thai"),
        (k + "a" * 9, "b" * 10, "thai_ratio_low", "has_thai"),
        (k * 2500, k * 2500, "ok", "has_thai"),
        (k * 2500 + "abc", k * 2500, "too_long", "has_thai"),
        (k + "ขคง", k * 5, "empty_message", "has_thai"),
        ("a" * 4000, "b" * 4002, "no_thai", "ok"),
        ("a" * 4000, "b" * 4003, "no_thai", "too_long"),
        ("abcd", "world", "no_thai", "empty_message"),
        (k + "a" * 9000, "world", "thai_ratio_low", "has_thai"),
    ]
    rows = [(i, [("user", q), ("assistant", a)]) for i, (q, a, _, _) in enumerate(cases)]
    limits = Limits()
    df = spark.createDataFrame(rows, f"id int, messages {ms.MESSAGES_TYPE}")
    got = (
        measures_of(df, "messages", THAI, limits)
        .select("id", target_reason(THAI, limits).alias("t"), other_reason(THAI, limits).alias("o"))
        .orderBy("id")
        .collect()
    )
    assert [(r["t"], r["o"]) for r in got] == [(t, o) for _, _, t, o in cases]


def _random_conversations(n, seed):
    pick = random.Random(seed)
    texts = ["q", "hello there", "  padded ", "été", " ", "", " \n", "abcd", "long " * 40,
             "àè", "x　"]
    made = {}
    for conv in range(n):
        length = pick.randint(1, 9)
        roles = pick.choice(
            [
                [("user", "assistant")[i % 2] for i in range(length)],
                pick.choices(["user", "assistant", "system", "tool"], k=length),
                ["system"] + [("user", "assistant")[i % 2] for i in range(length)],
            ]
        )
        made[conv] = [
            {"role": role, "content": pick.choice(texts[:4] if pick.random() < 0.7 else texts)}
            for role in roles
        ]
    return made


ACCENTED = Script("accented", "\\u00C0-\\u024F")


def _turns(spark, conversations):
    rows = [
        (conv, turn, m["role"], m["content"])
        for conv, messages in conversations.items()
        for turn, m in enumerate(messages)
    ]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


@pytest.mark.parametrize("segment", [1, 2, 3, 1024])
def test_turn_facts_agree_with_the_rules(spark, segment):
    conversations = _random_conversations(400, seed=segment)
    turns = _turns(spark, conversations)
    facts = conversation_facts(turns, ACCENTED, Limits(), segment)
    got = {r["conv_id"]: r for r in facts.collect()}
    assert set(got) == set(conversations)
    normal = {c: normal_form(m) for c, m in conversations.items()}
    assert sum(chat is not None for chat in normal.values()) > 50
    for conv, chat in normal.items():
        assert got[conv]["normalized"] == (chat is not None), conversations[conv]
        assert got[conv]["n_turns"] == len(conversations[conv])
        if chat is not None:
            expected = measures(chat, "[À-ɏ]")
            assert {k: got[conv][k] for k in expected} == expected, conversations[conv]
            assert got[conv]["n_messages"] == len(chat)


def test_turn_outputs_agree_with_the_rules(spark):
    conversations = _random_conversations(300, seed=7)
    turns = _turns(spark, conversations)
    facts = conversation_facts(turns, ACCENTED, Limits(), 2)
    normal = {c: chat for c, m in conversations.items() if (chat := normal_form(m)) is not None}

    long_form = {}
    for r in normalized_turns(turns, facts).orderBy("conv_id", "turn").collect():
        long_form.setdefault(r["conv_id"], []).append((r["role"], r["content"]))
    assert long_form == normal

    chosen = facts.filter("normalized").select("conv_id", "system_turn")
    arrays = {r["conv_id"]: [tuple(m) for m in r["messages"]] for r in assemble(turns, chosen).collect()}
    assert arrays == normal

    for n in (3, 500):
        got = {r["conv_id"]: r["opening"] for r in openings(turns, facts, n).collect()}
        assert got == {c: chat[0][1][:n] for c, chat in normal.items()}


def test_one_conversation_with_a_third_of_all_turns(spark):
    """A very long conversation is judged exactly, in segments."""
    long_chat = [{"role": ("user", "assistant")[i % 2], "content": f"turn {i}"} for i in range(3000)]
    broken = [dict(m) for m in long_chat]
    broken[1777]["role"] = "user"
    conversations = {0: [{"role": "system", "content": "be brief"}] + long_chat, 1: broken}
    conversations.update({c + 2: m for c, m in _random_conversations(600, seed=3).items()})
    facts = conversation_facts(_turns(spark, conversations), ACCENTED, Limits(), 64)
    got = {r["conv_id"]: r for r in facts.filter("conv_id < 2").collect()}
    assert got[0]["normalized"] and not got[1]["normalized"]
    expected = measures(normal_form(conversations[0]), "[À-ɏ]")
    assert {k: got[0][k] for k in expected} == expected


def test_conversation_text_of_anything(spark):
    cases = [
        ('[{"content":"a"},{"role":"x"},"b",5,{"content":null},{"content":"c"}]', "a  b c"),
        ('{"content":"a"}', ""),
        ("plain words", "plain words"),
        ('"quoted"', ""),
        ("[]", ""),
        (None, ""),
    ]
    df = spark.createDataFrame([(i, raw) for i, (raw, _) in enumerate(cases)], "i int, raw string")
    text = ms.conversation_text(ms.parse_json(F.col("raw")), F.col("raw"))
    got = [r[0] for r in df.orderBy("i").select(text).collect()]
    assert got == [expected for _, expected in cases]
    untouched = ms.conversation_text(None, F.col("raw"), decode=False)
    assert df.filter("i = 0").select(untouched).first()[0] == cases[0][0]
