import hashlib
import random

import pytest
from pyspark.sql import functions as F

from reference_rules import next_fit, scan
from turnmill.config import TIERS, tier_targets
from turnmill.functions import messages as ms, text as tx
from turnmill.functions.verdict import ACCEPTED
from turnmill.operators import order, packing, quota
from turnmill.plans import audits, curate


def _md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_default_targets():
    assert tier_targets(4000) == {"autoif": 1600, "sovereign": 800, "tulu_sft_en": 1600}


@pytest.mark.parametrize("digits", [1, 4])
@pytest.mark.parametrize("partitions", [1, 4, 37])
def test_cutoffs_are_exact(spark, digits, partitions):
    pick = random.Random(digits)
    rows = [(pick.choice("ab"), _md5(str(i // 2)), i) for i in range(3000)]  # keys come in pairs
    df = spark.createDataFrame(rows, "g string, key string, id bigint").repartition(partitions)
    for k in (0, 1, 2, 700, 10_000):
        cuts = order.cutoffs(df, ["g"], "key", ["id"], F.lit(k), digits)
        found = {r["g"]: r for r in cuts.collect()}
        assert set(found) == {"a", "b"}
        inside = df.join(cuts, "g").filter(order.within_cut("key", ["id"])).collect()
        for group, cut in found.items():
            mine = sorted((key, i) for g, key, i in rows if g == group)
            expected = mine[k - 1] if 0 < k <= len(mine) else None
            assert (cut["n_rows"], cut["k"]) == (len(mine), k)
            assert (cut["cut"] and tuple(cut["cut"])) == expected
            assert sorted((r["key"], r["id"]) for r in inside if r["g"] == group) == mine[:k]


def test_hot_key_cutoff(spark):
    """All rows in one group and all keys equal: the identifier decides."""
    df = spark.range(3000).select(F.lit("g").alias("g"), F.lit("f" * 32).alias("key"), "id")
    assert order.cutoffs(df, ["g"], "key", ["id"], F.lit(1234)).first()["cut"]["id"] == 1233


def test_small_side_is_checked(spark):
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(order.small_side(spark.range(10), 10)) and not hinted(order.small_side(spark.range(11), 10))


def _quota(spark, flags_by_tier, targets):
    rows, ident = [], 0
    for tier, flags in flags_by_tier.items():
        for place, flag in enumerate(flags):
            key = f"{place:08x}" + _md5(f"{tier}{place}")
            outcome = ACCEPTED if flag else "invalid_x"
            rows.append((ident, tier, targets[tier], outcome, key, place))
            ident += 1
    verdicts = spark.createDataFrame(
        rows,
        "conv_id bigint, tier string, target bigint, outcome string, draw_key string, place int",
    )
    marked = {}
    for r in quota.apply_quota(verdicts, quota.quota_cuts(verdicts)).orderBy("tier", "place").collect():
        marked.setdefault(r["tier"], ([], []))
        marked[r["tier"]][0].append(r["selected"])
        marked[r["tier"]][1].append(r["scanned"])
    return marked


def test_quota_cases(spark):
    pick = random.Random(5)
    flags = {
        "q1": [1, 0, 1, 0, 1],
        "q2": [1, 0, 0],
        "q3": [1, 1],
        "q4": [0, 0],
        "q5": [pick.random() < 0.3 for _ in range(900)],
    }
    targets = {"q1": 2, "q2": 2, "q3": 0, "q4": 1, "q5": 150}
    got = _quota(spark, flags, targets)
    assert got["q1"] == ([True, False, True, False, False], [True, True, True, False, False])
    assert got["q3"] == ([False, False], [False, False])
    for tier in flags:
        assert got[tier] == scan(flags[tier], targets[tier]), tier


@pytest.mark.parametrize("n, n_eval", [(0, 0), (4, 0), (5, 1), (54, 10), (1000, 200)])
def test_split_is_exact_and_exhaustive(spark, n, n_eval):
    rows = spark.range(n).select(
        F.col("id").alias("conv_id"), tx.draw_key(42, "split", F.col("id")).alias("split_key")
    )
    got = quota.exact_split(rows, 0.20).collect()
    assert len(got) == n and sum(r["split"] == "eval" for r in got) == n_eval
    in_order = sorted(got, key=lambda r: (r["split_key"], r["conv_id"]))
    assert all(r["split"] == "eval" for r in in_order[:n_eval])


def test_dedup_keeps_the_first_of_each_prefix(spark):
    same, system = "s" * 500, "y" * 600 + "\n\n"
    rows = [
        ("d1", 1, "a", "same text"), ("d2", 3, "0", "same text"),
        ("d3", 2, "b", same + "x"), ("d4", 2, "a", same + "z"),
        ("d5", 1, "a", "s" * 499 + "x"), ("d6", 1, "b", "s" * 499 + "z"),
        ("d7", 3, "b", system + "one"), ("d8", 1, "b", system + "two"),
    ]
    df = spark.createDataFrame(rows, "id string, tier_no int, draw_key string, t string")
    keyed = df.withColumn("k", tx.prefix_key(F.col("t"), 500))
    once = order.keep_first(keyed, ["k"], ["tier_no", "draw_key", "id"])
    assert {r["id"] for r in once.collect()} == {"d1", "d4", "d5", "d6", "d8"}
    twice = order.keep_first(once, ["k"], ["tier_no", "draw_key", "id"])
    assert {r["id"] for r in twice.collect()} == {"d1", "d4", "d5", "d6", "d8"}


def test_hot_duplicate_is_cut_before_the_shuffle(spark):
    copies = spark.range(0, 60_000, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k")
    )
    kept = order.keep_first(copies, ["k"], ["id"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    assert kept.count() == 40_001
    assert kept.filter("k = 'hot'").first()["id"] == 0


@pytest.mark.parametrize(
    "counts, expected",
    [
        (range(1, 11), (6, 10, 10, 10)),
        (range(1, 101), (51, 91, 96, 100)),
        ([7], (7, 7, 7, 7)),
        ([3, 3, 3, 9], (3, 9, 9, 9)),
    ],
)
def test_order_statistics(spark, counts, expected):
    df = spark.createDataFrame([("c", int(n)) for n in counts], "corpus string, n_tokens bigint")
    r = audits.token_distribution(df).first()
    assert (r["median"], r["p90"], r["p95"], r["p99"]) == expected
    assert (r["n"], r["low"], r["high"]) == (len(counts), min(counts), max(counts))
    assert r["mean"] == pytest.approx(sum(counts) / len(counts))


def test_token_limits(spark):
    rows = [("c", i, n) for i, n in enumerate([3500, 3501, 4096, 4097])]
    df = spark.createDataFrame(rows, "corpus string, line_no bigint, n_tokens bigint")
    r = audits.token_distribution(df).first()
    assert (r["over_warn"], r["over_max"]) == (2, 1)
    assert sorted(x["n_tokens"] for x in audits.within_limit(df).collect()) == [3500, 3501, 4096]
    assert audits.removed_counts(df).first()["n_removed"] == 1
    assert not audits.token_gate(df).first()["passed"]
    many = spark.range(100).selectExpr("'c' as corpus", "id as line_no", "if(id < 50, 5000L, 4000L) as n_tokens")
    shown = audits.over_limit(many).groupBy("over").count().collect()
    assert {r["over"]: r["count"] for r in shown} == {"max": 20, "warn": 10}


def test_counter_loaded_once_per_task(spark):
    def load():
        seen = {}  # a stand-in for a model file
        return lambda text: seen.setdefault(text, len(text.split()))

    df = spark.createDataFrame([("a b c",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(audits.counter_udf(load)("t")).collect()]
    assert got == [3, 0, None]


def test_template_overhead(spark):
    rows = [([("system", "s"), ("user", "q")],), ([("user", "q")],)]
    df = spark.createDataFrame(rows, f"m {ms.MESSAGES_TYPE}")
    got = [r[0] for r in df.select(audits.with_overhead(F.lit(10), F.col("m"), 3, 20)).collect()]
    assert got == [16, 33]


def test_first_stored_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 1000, 1, 7).write.parquet(path)
    table = spark.read.parquet(path)
    located = table.select("id", "_metadata.file_path", "_metadata.row_index").collect()
    in_order = [r["id"] for r in sorted(located, key=lambda r: (r["file_path"], r["row_index"]))]
    for n in (1, 150, 500, 5000):
        got = order.first_stored(table, n).collect()
        assert sorted(r["id"] for r in got) == sorted(in_order[:n])


@pytest.mark.parametrize("n_shards", [12, 1])
def test_packing_is_next_fit_in_draw_order(spark, n_shards):
    pick = random.Random(2)
    rows = [(i, pick.choice([5, 40, 90, 100, 130, 250]), _md5(str(i))) for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, n_tokens bigint, draw_key string")
    plan = packing.packing_plan(df.repartition(5), "id", 100, n_shards)
    got = {r["id"]: r for r in plan.collect()}
    shards = {}
    for ident, length, key in sorted(rows, key=lambda r: r[2]):
        shards.setdefault(got[ident]["shard"], []).append((ident, length))
    assert list(shards) == sorted(shards)
    assert len(shards) == n_shards
    for items in shards.values():
        assert [got[i]["bin"] for i, _ in items] == next_fit([n for _, n in items], 100)
    report = packing.packing_report(plan, 100, 16).first()
    bins = {(r["shard"], r["bin"]) for r in got.values()}
    assert (report["conversations"], report["bins"]) == (300, len(bins))
    assert report["oversized"] == sum(n > 100 for _, n, _ in rows)
    assert report["steps_per_epoch"] == -(-len(bins) // 16)


def test_packing_of_string_ids_and_of_one_row_more(spark):
    rows = [(f"c{i}", 10 + i % 50, _md5(str(i))) for i in range(400)]
    shape = "id string, n_tokens bigint, draw_key string"
    plan = lambda r: {x["id"]: (x["shard"], x["bin"]) for x in
                      packing.packing_plan(spark.createDataFrame(r, shape), "id", 100, 9).collect()}
    before, after = plan(rows), plan(rows + [("new", 33, "0" * 32)])
    assert after.pop("new")[0] == 0
    assert all(before[i] == after[i] for i in before if before[i][0] != 0)


def test_curating_rows_end_to_end(spark):
    """Thai by default; duplicates, quota, split and text all follow the rules."""
    k = "ภาษาไทย"
    rows = [
        (i, t.name, [("user", f"{k if t.rule == 'target' else 'text'} number {i // 2}"),
                     ("assistant", f"{k if t.rule == 'target' else 'reply'} {i}")])
        for t in TIERS
        for i in range(t.number * 1000, t.number * 1000 + 60)
    ]
    df = spark.createDataFrame(rows, f"id bigint, tier string, messages {ms.MESSAGES_TYPE}")
    quotas = quota.quota_table(spark, 100)
    results = []
    for partitions in (1, 4, 37):
        made = curate.curate_rows(df.repartition(partitions), quotas)
        corpus = made.corpus.collect()
        results.append(sorted((r["id"], r["tier"], r["split"]) for r in corpus))
        counts = curate.dedup_counts(made).first()
        assert counts["n_before"] == 100 and counts["n_after"] == len(corpus) < 100
        assert sum(r["split"] == "eval" for r in corpus) == int(len(corpus) * 0.2)
        assert len({r["messages"][0]["content"] for r in corpus}) == len(corpus)
    assert results[0] == results[1] == results[2]


def _chats(rows):
    return [(i, tier, [("user", text), ("assistant", f"{text} reply")]) for i, tier, text in rows]


CHAT = f"id bigint, tier string, messages {ms.MESSAGES_TYPE}"


def test_verdicts_end_where_the_quota_is_full(spark):
    """A tier far larger than its quota, and one that never fills it."""
    n = 9000
    pick = random.Random(9)
    kinds = {"autoif": 0.5, "sovereign": 0.001, "tulu_sft_en": 0.9}
    rows, place = [], 0
    for tier, rate in kinds.items():
        for _ in range(n // 3):
            good = pick.random() < rate
            thai = (tier != "tulu_sft_en") == good
            rows.append((place, tier, f"{'ไทยๆๆๆ' if thai else 'plain'} {place}"))
            place += 1
    df = spark.createDataFrame(_chats(rows), CHAT)
    made = curate.curate_rows(df.repartition(9), quota.quota_table(spark, 100))
    got = {r["id"]: r["selected"] for r in made.verdicts.collect()}
    targets, expected = tier_targets(100), {}
    for tier in kinds:
        mine = sorted((r for r in rows if r[1] == tier), key=lambda r: (_md5(f"42:{tier}:{r[0]}"), r[0]))
        flags = [("ไทย" in r[2]) == (tier != "tulu_sft_en") for r in mine]
        selected, scanned = scan(flags, targets[tier])
        expected.update({r[0]: s for r, s, looked in zip(mine, selected, scanned) if looked})
    assert got == expected
    assert sum(expected.values()) < 100 and len(expected) < n


def test_rejected_rows_stay_out_when_tiers_share_ids(spark):
    rows = [(i, "autoif", f"ภาษาไทย {i}") for i in range(10)]
    rows += [(i, "sovereign", f"plain text {i}") for i in range(10)]
    df = spark.createDataFrame(_chats(rows), CHAT)
    made = curate.curate_rows(df, quota.quota_table(spark, 20))
    corpus = made.corpus.collect()
    assert {r["tier"] for r in corpus} == {"autoif"} and len(corpus) == 8
    assert tuple(curate.dedup_counts(made).first()) == (8, 8)
    assert sum(r["split"] == "eval" for r in corpus) == 1


def test_split_is_exact_where_all_keys_are_shared(spark):
    rows = [(i, t.name, f"{'ไทยๆๆๆ' if t.rule == 'target' else 'plain'} {t.name} {i}") for t in TIERS for i in range(40)]
    corpus = curate.curate_rows(spark.createDataFrame(_chats(rows), CHAT), quota.quota_table(spark, 90)).corpus.collect()
    assert len(corpus) == 90 and sum(r["split"] == "eval" for r in corpus) == 18


def test_a_repeated_row_key_is_refused(spark):
    rows = [(1, "autoif", "ภาษาไทย a"), (1, "autoif", "ภาษาไทย b")]
    with pytest.raises(curate.RepeatedRow):
        curate.curate_rows(spark.createDataFrame(_chats(rows), CHAT), quota.quota_table(spark, 20))


def test_five_thousand_tiers(spark):
    """Quotas are a table: their number is bounded by nothing but its size."""
    quotas = spark.range(5000).select(
        F.concat(F.lit("t"), "id").alias("tier"), F.col("id").cast("int").alias("tier_no"),
        F.lit("other").alias("rule"), (F.col("id") % 2).alias("target"),
    )
    rows = [(i, f"t{i % 5000}", f"plain text {i}") for i in range(15000)]
    made = curate.curate_rows(spark.createDataFrame(_chats(rows), CHAT), quotas)
    counts = curate.quota_counts(made.verdicts, quotas).collect()
    assert len(counts) == 5000 and all(r["collected"] == r["target"] for r in counts)
    assert made.corpus.count() == 2500


@pytest.mark.parametrize("total", [50, 5000])
def test_tier_from_a_table_or_an_expression(spark, total):
    """Both ways agree with each other and keep the quota."""
    n = 3000
    rows = [
        (c, t, ("user", "assistant")[t], f"{'ไทยๆๆๆ' if c % 2 else 'plain'} text {c} {t}")
        for c in range(n)
        for t in (0, 1)
    ]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    tier = F.when(F.col("conv_id") % 4 < 2, "autoif").otherwise("tulu_sft_en")
    table = turns.select("conv_id").distinct().withColumn("tier", tier)
    quotas = quota.quota_table(spark, total)
    seen = []
    for way in (tier, table):
        made = curate.curate_turns(turns, way, quotas)
        seen.append(sorted((r["conv_id"], r["tier"], r["split"]) for r in made.corpus.collect()))
        got = curate.quota_counts(made.verdicts, quotas).collect()
        expected = {"autoif": min(n // 4, int(total * 0.4)), "sovereign": 0,
                    "tulu_sft_en": min(n // 4, int(total * 0.4))}
        assert {r["tier"]: r["collected"] for r in got} == expected
    assert seen[0] == seen[1]
