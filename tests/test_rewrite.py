"""Rewrites in place: names, order, counts, and runs that are broken off."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from turnmill.config import TokenLimits
from turnmill.plans import audits
from turnmill.sources import jsonl, rewrite

LIMITS = TokenLimits(max=50)
length = lambda text: F.length(text)


def line(text):
    return json.dumps([{"role": "user", "content": text}, {"role": "assistant", "content": "r"}])


SHORT, LONG = line("short"), line("x" * 100)


def write(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(text + "\n" for text in lines))


def tree(folder):
    return {str(p.relative_to(folder)): p.read_text() for p in sorted(folder.rglob("*")) if p.is_file() and ".crc" not in p.name}


def counts(found):
    return [tuple(r) for r in found.collect()]


def test_a_folder_of_files_keeps_their_names(spark, tmp_path):
    write(tmp_path / "c/train.jsonl", [SHORT, LONG, "", SHORT, LONG])
    write(tmp_path / "c/eval.jsonl", [SHORT])
    write(tmp_path / "c/only long.jsonl", [LONG])
    write(tmp_path / "c/a+b%20=c/none.jsonl", [])
    found = audits.filter_files(spark, str(tmp_path / "c"), length, LIMITS)
    assert counts(found) == [("a+b%20=c/none.jsonl", 0), ("eval.jsonl", 0), ("only long.jsonl", 1), ("train.jsonl", 2)]
    assert tree(tmp_path / "c") == {
        "a+b%20=c/none.jsonl": "", "eval.jsonl": SHORT + "\n", "only long.jsonl": "", "train.jsonl": (SHORT + "\n") * 2,
    }
    named = {r["corpus"] for r in jsonl.corpora(spark, str(tmp_path / "c")).collect()}
    assert named == {"a+b%20=c/none.jsonl", "eval.jsonl", "only long.jsonl", "train.jsonl"}


def test_a_single_file_stays_a_file(spark, tmp_path):
    write(tmp_path / "train.jsonl", [LONG, SHORT])
    write(tmp_path / "eval.jsonl", [LONG, SHORT])
    assert audits.filter_corpus(spark, str(tmp_path / "train.jsonl"), length, LIMITS) == 1
    assert tree(tmp_path) == {"train.jsonl": SHORT + "\n", "eval.jsonl": LONG + "\n" + SHORT + "\n"}


@pytest.mark.parametrize("run", ["0012345", "12e4567", "1e9999", "null", "2024-01-01", "__HIVE_DEFAULT_PARTITION__"])
def test_run_ids_are_text(spark, tmp_path, run):
    chats = spark.createDataFrame(
        [(s, [("user", t), ("assistant", "r")]) for s in ("train", "eval") for t in ("short", "x" * 100, "short")],
        "split string, messages array<struct<role string, content string>>",
    )
    root = str(tmp_path)
    jsonl.write_run(chats, root, run)
    jsonl.write_run(chats, root, "other")
    found = audits.filter_files(spark, root, length, LIMITS, corpus="run_id")
    assert counts(found) == sorted([(run, 2), ("other", 2)])
    for name in (run, "other"):
        lines = jsonl.read_run(spark, root, name)
        assert sorted((r["corpus"], r["n"]) for r in lines.groupBy("corpus").agg(F.count("*").alias("n")).collect()) == [("eval", 2), ("train", 2)]
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted([f"run_id={run}", "run_id=other"])


def test_large_files_become_ordered_parts_of_one_corpus(spark, tmp_path):
    path = tmp_path / "c" / "train.jsonl"
    write(path, [line(f"{k:05d}" + "y" * (k % 3 * 60)) for k in range(900)])
    want = [text for text in path.read_text().splitlines() if len(text) < 180]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        for _ in range(2):  # the second time over the parts
            audits.filter_files(spark, str(tmp_path / "c"), length, TokenLimits(max=70))
            assert path.is_dir() and len(list(path.rglob("part-*"))) > 3
            parts = sorted(p for p in path.rglob("part-*") if p.is_file())
            assert [text for p in parts for text in p.read_text().splitlines()] == want
        from turnmill.session import materialize

        numbered = jsonl.with_line_numbers(materialize(jsonl.read_lines(spark, str(tmp_path / "c")), "lines"))
        assert [r["line"] for r in numbered.orderBy("line_no").collect()] == want
        assert {r["corpus"] for r in numbered.collect()} == {"train.jsonl"}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_packed_files_are_unpacked_under_a_plain_name(spark, tmp_path):
    with gzip.open(tmp_path / "train.jsonl.gz", "wt") as out:
        out.write(SHORT + "\n" + LONG + "\n")
    assert audits.filter_corpus(spark, str(tmp_path), length, LIMITS) == 1
    assert tree(tmp_path) == {"train.jsonl": SHORT + "\n"}


def test_lines_are_not_moved(spark, tmp_path):
    write(tmp_path / "train.jsonl", [SHORT, LONG])
    counted = audits.count_lines(jsonl.read_ordered(spark, str(tmp_path)), length)
    plan = rewrite.staged_lines(spark, str(tmp_path), counted, F.col("n_tokens") <= 50)
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


class Broken(Exception):
    pass


def _raise(*_):
    raise Broken


@pytest.mark.parametrize("done", ["nothing", "manifest", 0, 1, 2])
def test_a_run_that_breaks_off_leaves_one_version(spark, tmp_path, monkeypatch, done):
    """Before the manifest the old version stands, after it the next reader ends the work."""
    folder = tmp_path / "c"
    write(folder / "train.jsonl", [SHORT, LONG, SHORT])
    write(folder / "eval.jsonl", [LONG, SHORT])
    write(folder / "test.jsonl", [LONG])
    before = tree(folder)
    with monkeypatch.context() as patch:
        patch.setattr(rewrite, "_commit" if done == "nothing" else "_publish", _raise)
        with pytest.raises(Broken):
            audits.filter_files(spark, str(folder), length, LIMITS)
    control = folder / "_rewrite"
    if isinstance(done, int):  # some parts have their names, and one more old file is gone
        manifest = json.loads((control / "manifest.json").read_text())
        for source, target in manifest["parts"][:done]:
            (control / manifest["data"] / source).replace(folder / target)
        (folder / manifest["parts"][done][1]).unlink()
    else:
        assert {k: v for k, v in tree(folder).items() if not k.startswith("_")} == before
    read = sorted(r["line"] for r in jsonl.read_lines(spark, str(folder)).collect())
    assert read == (sorted([SHORT, LONG] * 3) if done == "nothing" else [SHORT] * 3)
    assert control.exists() == (done == "nothing")
    assert audits.filter_corpus(spark, str(folder), length, LIMITS) == (3 if done == "nothing" else 0)
    assert tree(folder) == {"train.jsonl": (SHORT + "\n") * 2, "eval.jsonl": SHORT + "\n", "test.jsonl": ""}


def test_a_reader_of_a_part_ends_the_work_too(spark, tmp_path, monkeypatch):
    for run in ("a", "b"):
        write(tmp_path / f"run_id={run}/split=train/part-0.txt", [SHORT, LONG])
    with monkeypatch.context() as patch:
        patch.setattr(rewrite, "_publish", _raise)
        with pytest.raises(Broken):
            audits.filter_files(spark, str(tmp_path), length, LIMITS)
    assert [r["line"] for r in jsonl.read_run(spark, str(tmp_path), "b").collect()] == [SHORT]
    assert not (tmp_path / "_rewrite").exists()
