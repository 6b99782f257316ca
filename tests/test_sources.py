import json

import pytest
from pyspark.sql import functions as F

from turnmill.config import TokenLimits
from turnmill.functions import messages as ms
from turnmill.plans import audits
from turnmill.session import materialize, work_dir
from turnmill.sources import jsonl, tables


def _chats(spark, n=6):
    rows = [
        (i, "train" if i % 3 else "eval", [("user", f"ถาม \"{i}\" \n é"), ("assistant", f"ตอบ {i}")])
        for i in range(n)
    ]
    return spark.createDataFrame(rows, f"id bigint, split string, messages {ms.MESSAGES_TYPE}")


def test_lines_hold_only_messages_and_stay_readable(spark, tmp_path):
    jsonl.write_jsonl(_chats(spark), str(tmp_path / "out"))
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert any("ถาม" in line for line in lines) and not any("\\u0e" in line for line in lines)
    parsed = sorted((json.loads(line) for line in lines), key=lambda m: m[0]["content"])
    assert [m[0]["content"] for m in parsed] == [f'ถาม "{i}" \n é' for i in range(6)]
    assert all(set(x) == {"role", "content"} for m in parsed for x in m)


def test_prompt_file(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text(
        '[{"role":"user","content":"a"}]\n\n  \n[{"role":"user","content":"b"},{"role":"user","content":"c"}]\n'
    )
    got = jsonl.read_prompts(spark, str(tmp_path / "p.jsonl")).collect()
    assert [[m["content"] for m in r["messages"]] for r in got] == [["a"], ["b", "c"]]


def test_runs_are_kept_apart(spark, tmp_path):
    root = str(tmp_path)
    jsonl.write_run(_chats(spark), root, "a")
    jsonl.write_run(_chats(spark, 3), root, "b")
    jsonl.write_run(_chats(spark, 9), root, "b")
    count = lambda run, split=None: jsonl.read_run(spark, root, run, split).count()
    assert (count("a", "eval"), count("a", "train"), count("b")) == (2, 4, 9)
    assert {r["corpus"] for r in jsonl.read_run(spark, root, "a").collect()} == {"train", "eval"}
    for run, split in (("c", None), ("a", "test")):
        with pytest.raises(jsonl.EmptyCorpus):
            jsonl.read_run(spark, root, run, split)


def test_rewrite_in_place(spark, tmp_path):
    path = str(tmp_path / "t")
    jsonl.write_jsonl(_chats(spark), path)
    keep = jsonl.read_ordered(spark, path).filter(F.col("line").contains('"ตอบ 1"'))
    assert jsonl.rewrite_lines(spark, path, keep) == 1
    assert spark.read.text(path).count() == 1
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def _line(text, reply="r"):
    return json.dumps([{"role": "user", "content": text}, {"role": "assistant", "content": reply}])


def test_filtering_a_run_keeps_its_splits_and_the_order_of_lines(spark, tmp_path):
    """Parts of very different size; one split loses all its lines."""
    run = tmp_path / "run_id=a"
    numbers = iter(range(10_000))
    for split, sizes in (("train", [5, 400, 50]), ("eval", [3])):
        (run / f"split={split}").mkdir(parents=True)
        for part, size in enumerate(sizes):
            lines = [_line("x" * (4000 if split == "eval" or k % 7 == 3 else 4), str(next(numbers))) for k in range(size)]
            (run / f"split={split}" / f"part-{part}.txt").write_text("\n".join(lines) + "\n\n")
    want = [line for p in sorted((run / "split=train").iterdir()) for line in p.read_text().splitlines() if line and len(line) < 2000]
    removed = audits.filter_corpus(spark, str(run), lambda t: F.length(t), TokenLimits(max=500))
    assert removed == 455 - len(want) + 3
    numbered = jsonl.with_line_numbers(materialize(jsonl.read_run(spark, str(tmp_path), "a", "train"), "lines"))
    assert [r["line"] for r in numbered.orderBy("line_no").collect()] == want
    assert {r["corpus"] for r in numbered.collect()} == {"train"}
    assert jsonl.read_run(spark, str(tmp_path), "a", "eval").count() == 0


def test_files_are_named_by_their_place_and_all_reported(spark, tmp_path):
    for name, lines in (("a/train.jsonl", [_line("q"), "no json"]), ("b/train.jsonl", [_line("q")]), ("b/none.jsonl", [])):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("".join(x + "\n" for x in lines))
    glob = f"{tmp_path}/*/*.jsonl"
    lines, named = jsonl.read_lines(spark, glob), jsonl.corpora(spark, glob)
    report = audits.audit_summary(audits.audit_read(lines), named).collect()
    got = [(r["corpus"], r["n_valid"], r["n_errors"]) for r in report]
    assert got == [("a/train.jsonl", 1, 1), ("b/none.jsonl", 0, 0), ("b/train.jsonl", 1, 0)]
    counted = audits.count_read(jsonl.read_lines(spark, f"{tmp_path}/b/*.jsonl"), lambda t: F.length(t))
    figures = audits.token_distribution(counted, corpora=jsonl.corpora(spark, f"{tmp_path}/b/*.jsonl"))
    assert [(r["corpus"], r["n"], r["median"]) for r in figures.collect()] == [("none.jsonl", 0, 0), ("train.jsonl", 1, 3)]
    one = jsonl.read_lines(spark, f"{tmp_path}/a/train.jsonl").select("corpus").distinct().collect()
    assert [r["corpus"] for r in one] == ["train.jsonl"]


def test_a_split_without_rows_stays_readable(spark, tmp_path):
    jsonl.write_run(_chats(spark).filter("split = 'train'"), str(tmp_path), "a")
    assert jsonl.read_run(spark, str(tmp_path), "a", "eval").count() == 0
    assert jsonl.read_run(spark, str(tmp_path), "a").count() == 4


def test_a_bad_prompt_line_stops(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text('[{"role":"user","content":"a"}]\nnot json\n')
    with pytest.raises(Exception, match="not a JSON list"):
        jsonl.read_prompts(spark, str(tmp_path / "p.jsonl")).collect()


def test_template_counts_of_lines(spark, tmp_path):
    path = str(tmp_path / "l.jsonl")
    system = json.dumps([{"role": "system", "content": "s"}, {"role": "user", "content": "a b"}])
    (tmp_path / "l.jsonl").write_text(_line("one two") + "\n" + system + "\n")
    words = audits.counter_udf(lambda: lambda text: len(text.split()))
    template = lambda n, m: audits.with_overhead(n, m, per_message=4, system_prompt=20)
    counted = audits.count_read(jsonl.read_lines(spark, path), words, template)
    assert [r["n_tokens"] for r in counted.orderBy("line_no").collect()] == [3 + 8 + 20, 3 + 8]


def test_deep_and_long_json(spark):
    deep, number = "[" * 1200 + "]" * 1200, "[" + "1" * 1500 + "]"
    rows = spark.createDataFrame([(deep,), (number,), ("[1",)], "t string")
    assert [r[0] for r in rows.select(ms.parse_json(F.col("t")).isNotNull()).collect()] == [True, True, False]


def test_records_are_written_per_variant(spark, tmp_path):
    path = str(tmp_path / "r")
    rows = [(1, "base", "q", None), (1, "adapter", "q", "r")]
    df = spark.createDataFrame(rows, "prompt_id int, variant string, prompt string, response string")
    jsonl.write_records(df, path, ["variant"])
    assert spark.read.json(f"{path}/variant=base").columns == ["prompt", "prompt_id", "response"]
    assert spark.read.json(path).count() == 2


def test_save_if_absent(spark, tmp_path):
    path = str(tmp_path / "s")
    tables.save_if_absent(spark.range(3), path)
    tables.save_if_absent(spark.range(9), path)
    assert tables.load_split(spark, path).count() == 3


def test_load_matching_merges_columns(spark, tmp_path):
    spark.range(2).selectExpr("id", "id as a").write.parquet(f"{tmp_path}/x_train_0.parquet")
    spark.range(3).selectExpr("id", "'s' as b").write.parquet(f"{tmp_path}/x_train_1.parquet")
    spark.range(5).write.parquet(f"{tmp_path}/x_test.parquet")
    merged = tables.load_matching(spark, str(tmp_path), "*train*.parquet")
    assert merged.count() == 5 and set(merged.columns) == {"id", "a", "b"}


def test_inventory_reports_what_is_missing(spark, tmp_path):
    spark.range(4).write.parquet(f"{tmp_path}/here")
    got = tables.split_inventory(spark, {"here": f"{tmp_path}/here", "gone": f"{tmp_path}/gone"})
    assert [tuple(r) for r in got.orderBy("name").collect()] == [
        ("gone", False, None, None),
        ("here", True, 4, "id"),
    ]


def test_prompt_column_becomes_messages(spark):
    rows = [(1, [("user", "q")]), (2, []), (3, None)]
    df = spark.createDataFrame(rows, f"id int, prompt {ms.MESSAGES_TYPE}")
    assert [r["id"] for r in tables.prompt_as_messages(df).collect()] == [1]
    both = tables.union_splits(_chats(spark).select("messages"), tables.prompt_as_messages(df))
    assert both.count() == 7 and both.filter("id is null").count() == 6


def test_work_folder_is_the_named_one(spark, monkeypatch):
    from turnmill import session

    first = work_dir(spark)
    assert work_dir(spark) == first  # one folder per session

    class Named:
        def __init__(self, master, settings):
            self.sparkContext = type("C", (), {"master": master, "applicationId": "x"})()
            self.conf = type("F", (), {"get": staticmethod(lambda k, d: settings.get(k, d))})()

    named = Named("spark://host", {session.WORK_DIR_CONF: "hdfs://shared/dir/"})
    assert work_dir(named) == "hdfs://shared/dir"
    with pytest.raises(RuntimeError):
        work_dir(Named("spark://host", {}))


def test_materialized_rows_do_not_change(spark):
    kept = materialize(spark.range(100).withColumn("r", F.rand()), "rand")
    assert kept.collect() == kept.collect()
