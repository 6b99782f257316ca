from pyspark.sql import functions as F

from turnmill.config import THAI, Script
from turnmill.functions import text as tx


def _one(spark, text, expression):
    return spark.createDataFrame([(text,)], "t string").select(expression.alias("x")).first()[0]


def test_whitespace_is_what_python_strips():
    assert set(tx.WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}
    assert len(tx.WHITESPACE) == 29


def test_token_estimates(spark):
    cases = [("", 0), ("สวัสดี", 2), ("abc", 0), ("ก" * 5 + "abcd", 3)]
    for text, expected in cases:
        assert _one(spark, text, tx.estimate_tokens(F.col("t"), THAI)) == expected


def test_strip_and_spoken(spark):
    for text in ["", " ", " 　", "  a b \n", "\x1c\x85x", "​x", "﻿"]:
        assert _one(spark, text, tx.strip(F.col("t"))) == text.strip()
        assert _one(spark, text, tx.is_spoken(F.col("t"))) == bool(text.strip())
        stripped_left = len(text) - len(text.lstrip())
        assert _one(spark, text, tx.leading_blanks(F.col("t"))) == stripped_left
        stripped_right = len(text) - len(text.rstrip())
        assert _one(spark, text, tx.trailing_blanks(F.col("t"))) == stripped_right
    assert _one(spark, None, tx.is_spoken(F.col("t"))) is False


def test_script_ratio(spark):
    assert _one(spark, "", tx.script_ratio(F.col("t"), THAI)) == 0.0
    assert _one(spark, "   ", tx.script_ratio(F.col("t"), THAI)) == 0.0
    assert _one(spark, " กabc ", tx.script_ratio(F.col("t"), THAI)) == 0.25
    assert _one(spark, "ก" * 7, tx.script_ratio(F.col("t"), THAI)) == 1.0


def test_lengths_count_code_points(spark):
    assert _one(spark, "\U0001f600a", F.length("t")) == 2
    assert _one(spark, "a" * 499 + "\U0001f600z", tx.prefix_key(F.col("t"), 500)) == _one(
        spark, "a" * 499 + "\U0001f600y", tx.prefix_key(F.col("t"), 500)
    )


def test_percent_of_nothing(spark):
    assert _one(spark, "", tx.percent(F.lit(0), F.lit(0))) is None
    assert _one(spark, "", tx.percent(F.lit(1), F.lit(8))) == 12.5


def test_scripts_with_and_without_ascii_letters(spark):
    hexadecimal = Script("hex", "0-9a-fé")
    assert hexadecimal.has_ascii and not THAI.has_ascii
    for text, n_hex, n_thai in [("abcxyz", 3, 0), ("é ก", 1, 1), ("", 0, 0), ("กขz", 0, 2)]:
        for script, n in ((hexadecimal, n_hex), (THAI, n_thai)):
            assert _one(spark, text, tx.script_chars(F.col("t"), script)) == n
            assert _one(spark, text, tx.contains_script(F.col("t"), script)) == (n > 0)
    assert _one(spark, None, tx.contains_script(F.col("t"), THAI)) is None
