import json

import pytest

from turnmill.config import THAI
from turnmill.plans import audits
from turnmill.sources import jsonl

LINES = [  # (line, code, message index)
    ('[{"role":"user","content":"q"},{"role":"assistant","content":"r"}]', "valid", None),
    ("   ", None, None),
    ("not json", "invalid_json", None),
    ('{"role":"user","content":"q"}', "not_list", None),
    ('[{"role":"user","content":"q"}]', "too_few", None),
    ('["a","b"]', "msg_not_dict", 0),
    ('[{"role":"user"},{"role":"assistant","content":"r"}]', "missing_key", 0),
    ('[{"role":"system","content":"s"},{"role":"user","content":"q"}]', "bad_role", 0),
    ('[{"role":null,"content":"q"},{"role":"assistant","content":"r"}]', "bad_role", 0),
    ('[{"role":"user","content":null},{"role":"assistant","content":"r"}]', "empty_content", 0),
    ('[{"role":"user","content":"q"},{"role":"assistant","content":" "}]', "empty_content", 1),
    ('[{"role":"assistant","content":"r"},{"role":"user","content":"q"}]', "bad_start", None),
    (
        '[{"role":"user","content":"q"},{"role":"assistant","content":"r"},'
        '{"role":"user","content":"q"}]',
        "bad_end",
        None,
    ),
    (
        '[{"role":"user","content":"q"},{"role":"user","content":"q"},'
        '{"role":"assistant","content":"r"}]',
        "non_alternating",
        0,
    ),
    ('[{"role":"x","content":""},{"a":1}]', "bad_role", 0),
    ("[]", "too_few", None),
]
DETAILS = {4: "dict", 5: "1", 8: "system", 9: None, 15: "x", 16: "0"}


def test_every_fault_is_found_and_numbered(spark, tmp_path):
    (tmp_path / "bad.jsonl").write_text("\n".join(line for line, _, _ in LINES) + "\n")
    audited = audits.audit_read(jsonl.read_lines(spark, f"{tmp_path}/*.jsonl"), THAI)
    got = {r["line_no"]: r for r in audited.collect()}
    expected = {i: (code, at) for i, (_, code, at) in enumerate(LINES, 1) if code}
    assert {n: (r["code"], r["msg_index"]) for n, r in got.items()} == expected
    assert {n: got[n]["detail"] for n in DETAILS} == DETAILS

    summary = audits.audit_summary(audited).first()
    assert (summary["corpus"], summary["n_valid"], summary["n_errors"]) == ("bad.jsonl", 1, 14)
    assert (summary["n_script"], summary["n_other"], summary["mean_turns"]) == (0, 1, 2.0)
    shown = audits.first_errors(audited).orderBy("line_no").collect()
    assert [r["line_no"] for r in shown] == list(range(3, 13))
    with pytest.raises(audits.GateFailed):
        audits.require_passed(audits.format_gate(audited))


@pytest.mark.parametrize(
    "value, name",
    [("5", "int"), ("1.5", "float"), ("1e3", "float"), ("true", "bool"), ("null", "NoneType"), ('"s"', "str")],
)
def test_type_of_a_line_that_is_no_list(spark, value, name):
    lines = spark.createDataFrame([("c", 1, value)], "corpus string, line_no bigint, line string")
    row = audits.audit_numbered(lines, THAI).first()
    assert (row["code"], row["detail"]) == ("not_list", name)


def test_a_corpus_without_a_valid_line_has_no_shares(spark):
    lines = spark.createDataFrame([("c", 1, "[]")], "corpus string, line_no bigint, line string")
    row = audits.audit_summary(audits.audit_numbered(lines, THAI)).first()
    assert row["pct_script"] is None and row["pct_other"] is None and row["mean_turns"] is None


def test_line_numbers_across_blocks_files_and_line_ends(spark, tmp_path):
    """Many scan splits per file, blank lines, and three kinds of line end."""
    expected = {}
    for name, end, n in (("a.jsonl", "\n", 4000), ("b.jsonl", "\r\n", 1500), ("c.jsonl", "\r", 300)):
        lines = ["" if i % 7 == 3 else json.dumps([f"{name} {i}", "x" * (i % 90)]) for i in range(n)]
        (tmp_path / name).write_bytes((end.join(lines) + end).encode())
        expected.update({(name, i): line for i, line in enumerate(lines, 1)})
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = jsonl.read_lines(spark, f"{tmp_path}/*.jsonl")
        assert lines.rdd.getNumPartitions() > 8
        from turnmill.session import materialize

        stored = materialize(lines, "lines")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert stored.select("file", "block").distinct().count() > 8
    rows = jsonl.with_line_numbers(stored).collect()
    assert {(r["corpus"], r["line_no"]): r["line"] for r in rows} == expected


def test_no_file_is_a_failure(spark, tmp_path):
    with pytest.raises(jsonl.EmptyCorpus):
        jsonl.read_lines(spark, f"{tmp_path}/*.jsonl")


def test_audit_of_a_stream(spark, tmp_path):
    from turnmill.streaming.lines import audit_arrivals

    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "x.jsonl").write_text("\n".join(line for line, _, _ in LINES))
    query = (
        audit_arrivals(spark, str(folder))
        .writeStream.format("memory")
        .queryName("arrivals")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(60)
    got = sorted(r["code"] for r in spark.table("arrivals").collect())
    assert got == sorted(code for _, code, _ in LINES if code)


def _words(text):
    from pyspark.sql import functions as F

    return F.size(F.split(text, " ")).cast("bigint")


def test_tokens_of_written_lines(spark, tmp_path):
    texts = ["a b c", "d " * 30 + "e", "f"]
    lines = [json.dumps([{"role": "user", "content": t}]) for t in texts]
    lines.insert(1, "  ")
    (tmp_path / "t.jsonl").write_text("\n".join(lines) + "\n")
    counted = audits.count_read(jsonl.read_lines(spark, f"{tmp_path}/*.jsonl"), _words)
    got = sorted((r["line_no"], r["n_tokens"]) for r in counted.collect())
    assert got == [(1, 3), (3, 31), (4, 1)]

    from turnmill.config import TokenLimits

    folder = str(tmp_path / "table")
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(folder)
    assert audits.filter_corpus(spark, folder, _words, TokenLimits(max=10)) == 1
    left = sorted(r["value"] for r in spark.read.text(folder).collect())
    assert left == sorted([lines[0], lines[3]])


def test_tokens_of_a_broken_line_stop_the_job(spark):
    lines = spark.createDataFrame([("c", "not json")], "corpus string, line string")
    with pytest.raises(Exception, match="not JSON"):
        audits.count_lines(lines, _words).collect()
