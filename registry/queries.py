"""The registered queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from registry import inputs as src
from registry.inputs import ACCENTED, LIMITS, TOKEN_LIMITS
from turnmill.config import PROFILE_ROWS, SEED, TIERS, TokenLimits
from turnmill.functions import messages as ms, text as tx
from turnmill.functions.verdict import measures_of, other_reason, outcome, target_reason
from turnmill.operators import nextfit, order, packing, quota
from turnmill.operators.turns import conversation_facts, normalized_turns, openings
from turnmill.plans import audits, curate, profile, scoring
from turnmill.session import fresh_path, materialize
from turnmill.sources import jsonl, tables

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_facts(src.turns(spark, sf_dir), ACCENTED, LIMITS)


def _quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quota.quota_table(spark, src.quota_total(spark, sf_dir))


def _curated(spark: SparkSession, sf_dir: str) -> curate.Curated:
    return curate.curate_turns(
        src.turns(spark, sf_dir), src.tier(), _quotas(spark, sf_dir), ACCENTED, LIMITS
    )


def _verdicts(spark: SparkSession, sf_dir: str, quotas: DataFrame) -> DataFrame:
    return curate.turn_verdicts(src.turns(spark, sf_dir), src.tier(), quotas, ACCENTED, LIMITS)


# Text functions


@query
def script_stats(spark, sf_dir):
    text = F.col("text")
    return src.table(spark, sf_dir, "documents").select(
        "doc_id",
        F.length(text).cast("bigint").alias("n_chars"),
        F.length(tx.strip(text)).cast("bigint").alias("n_stripped"),
        tx.contains_script(text, ACCENTED).alias("has_script"),
        tx.script_chars(text, ACCENTED).cast("bigint").alias("n_script"),
        tx.script_ratio(text, ACCENTED).alias("ratio"),
        tx.estimate_tokens(text, ACCENTED).alias("n_tokens"),
        tx.is_spoken(text).alias("is_spoken"),
        tx.prefix_key(text, LIMITS.dedup_chars).alias("prefix_key"),
        tx.preview(text, 60).alias("preview"),
    )


@query
def plugged_token_counts(spark, sf_dir):
    """A caller's own counter: here the number of space-separated words."""
    count = audits.counter_udf(_load_word_counter)
    return src.table(spark, sf_dir, "documents").select("doc_id", count("text").alias("n_tokens"))


def _load_word_counter():
    return lambda text: len(text.split(" "))


# Profile


@query
def conversation_text(spark, sf_dir):
    turns = src.turns(spark, sf_dir)
    return profile.conversation_sizes(turns, ACCENTED).join(profile.opening_text(turns), "conv_id")


@query
def exchange_text(spark, sf_dir):
    m = F.col("messages")
    return src.exchanges(spark, sf_dir).select(
        "id",
        F.md5(ms.joined_text(m)).alias("text_md5"),
        F.length(ms.first_text_of(m, "user")).cast("bigint").alias("first_user_chars"),
        tx.preview(ms.last_text(m), 120).alias("last_preview"),
        ms.starts_with_role(m, "system").alias("starts_with_system"),
    )


@query
def json_conversation_text(spark, sf_dir):
    """Text of conversations stored as JSON, whatever the JSON holds."""
    parsed = src.chat_json(spark, sf_dir).withColumn("document", ms.parse_messages(F.col("json")))
    first = F.try_variant_get("document", "$[0].content", "variant")
    return parsed.select(
        "doc_id",
        F.size(ms.elements(F.col("document"))).cast("bigint").alias("n_items"),
        F.md5(ms.conversation_text(F.col("document"), F.col("json"))).alias("text_md5"),
        ms.written_preview(first, 150).alias("first_preview"),
    )


@query
def source_histogram(spark, sf_dir):
    tagged = src.tag(src.conversation_ids(spark, sf_dir))
    return profile.source_histogram(tagged.filter(F.col("dataset") == src.MAIN))


@query
def turn_stats(spark, sf_dir):
    return profile.turn_stats(profile.turn_counts(src.turns(spark, sf_dir)))


@query
def row_turn_stats(spark, sf_dir):
    return profile.turn_stats(profile.measured_rows(src.exchanges(spark, sf_dir), ACCENTED))


@query
def row_script_share(spark, sf_dir):
    rows = src.exchanges(spark, sf_dir).withColumn("source", src.source())
    return profile.script_share_by_source(profile.measured_rows(rows, ACCENTED))


@query
def json_script_share(spark, sf_dir):
    """Conversations as JSON text, in a table without a source column."""
    rows = src.chat_json(spark, sf_dir).select(F.col("json").alias("messages"))
    return profile.script_share_by_source(profile.measured_rows(rows, ACCENTED))


@query
def row_sample_messages(spark, sf_dir):
    """The first exchange of every class, message by message."""
    rows = src.exchanges(spark, sf_dir).withColumn("source", src.source())
    first = profile.sample_by_class(rows.filter(src.dataset() == src.MAIN), "id")
    shown = profile.sample_row_messages(rows.join(F.broadcast(first.select("id")), "id"))
    return shown.withColumn("place", F.col("place").cast("bigint"))


@query
def script_share_first_n(spark, sf_dir):
    head = profile.first_conversations(src.turns(spark, sf_dir), PROFILE_ROWS)
    return profile.script_share(profile.script_flags(head, ACCENTED))


@query
def script_share_by_source(spark, sf_dir):
    head = profile.first_conversations(src.turns(spark, sf_dir), PROFILE_ROWS)
    return profile.script_share_by_source(src.tag(profile.script_flags(head, ACCENTED)))


@query
def script_share_first_stored(spark, sf_dir):
    """The same over the first rows of a Parquet table in storage order."""
    head = order.first_stored(src.table(spark, sf_dir, "documents"), PROFILE_ROWS)
    flagged = head.withColumn("has_script", tx.contains_script(F.col("text"), ACCENTED))
    return profile.script_share_by_source(flagged)


@query
def head_that_cuts(spark, sf_dir):
    """The first 15 conversations, fewer than any of the tables has."""
    head = profile.first_conversations(src.turns(spark, sf_dir), 15)
    return profile.script_flags(head, ACCENTED).select("conv_id", "has_script")


@query
def stored_head_that_cuts(spark, sf_dir):
    """The first 150 rows in storage order, fewer than any of the tables has."""
    return order.first_stored(src.table(spark, sf_dir, "documents"), 150).select("doc_id", "source")


@query
def short_segments(spark, sf_dir):
    """Facts of conversations cut into segments of three turns."""
    facts = conversation_facts(src.turns(spark, sf_dir), ACCENTED, LIMITS, segment=3)
    return facts.filter("normalized").select(
        "conv_id", "n_messages", "n_chars", "n_stripped", "n_script", "has_short"
    )


def _samples(spark, sf_dir):
    tagged = src.tag(src.conversation_ids(spark, sf_dir))
    main, rest = (tagged.filter(F.col("dataset") == src.MAIN), F.col("dataset") != src.MAIN)
    return main, tagged.filter(rest)


@query
def sample_by_class(spark, sf_dir):
    main, _ = _samples(spark, sf_dir)
    return profile.sample_by_class(main)


@query
def first_of_each_split(spark, sf_dir):
    _, rest = _samples(spark, sf_dir)
    return profile.first_of_each(rest)


@query
def sample_messages(spark, sf_dir):
    main, rest = _samples(spark, sf_dir)
    shown = profile.sample_by_class(main).select("conv_id").unionByName(
        profile.first_of_each(rest).select("conv_id")
    )
    messages = profile.sample_messages(src.turns(spark, sf_dir), shown)
    return messages.withColumn("place", F.col("place").cast("bigint"))


@query
def split_inventory(spark, sf_dir):
    names = ["conversations", "documents", "benchmark", "not_there"]
    return tables.split_inventory(spark, {n: f"{sf_dir}/{n}.parquet" for n in names})


@query
def tier_assignment(spark, sf_dir):
    tagged = src.tag(src.conversation_ids(spark, sf_dir)).withColumn("tier", src.tier())
    return tagged.groupBy("dataset", "source", "tier").agg(F.count(F.lit(1)).alias("n"))


@query
def sovereign_union(spark, sf_dir):
    """Two splits of one tier that name their conversation differently."""
    chats = src.exchanges(spark, sf_dir).withColumn("dataset", src.dataset())
    first = chats.filter(F.col("dataset") == "sovereign_messages").select("id", "messages")
    answered = F.when(F.size("messages") > 1, F.col("messages")).otherwise(F.array())
    second = chats.filter(F.col("dataset") == "sovereign_prompt").select(
        "id", answered.alias("prompt"), F.col("dataset").alias("origin")
    )
    both = tables.union_splits(first, tables.prompt_as_messages(second))
    return both.select(
        "id",
        "origin",
        F.size("messages").cast("bigint").alias("n_messages"),
        F.md5(ms.joined_text(F.col("messages"))).alias("text_md5"),
    )


@query
def first_present_column(spark, sf_dir):
    """`messages` where it holds something, else `prompt`."""
    chats = src.exchanges(spark, sf_dir)
    answered = F.when(F.size("messages") > 1, F.col("messages"))
    asked = F.filter("messages", lambda x: x["role"] == "user")
    shown = ms.first_present(F.col("m"), F.col("p"))
    return chats.select("id", answered.alias("m"), asked.alias("p")).select(
        "id",
        F.size(shown).cast("bigint").alias("n_messages"),
        F.md5(ms.last_text(shown)).alias("last_md5"),
    )


# Normalising and validating


@query
def normalized_conversations(spark, sf_dir):
    turns = src.turns(spark, sf_dir)
    return normalized_turns(turns, conversation_facts(turns, ACCENTED, LIMITS)).select(
        "conv_id",
        "turn",
        "role",
        F.length("content").cast("bigint").alias("n_chars"),
        F.md5("content").alias("content_md5"),
    )


@query
def normalize_json(spark, sf_dir):
    inspected = ms.inspect_json(ms.elements(ms.parse_messages(F.col("json"))))
    chats = src.chat_json(spark, sf_dir).withColumn("_inspected", inspected)
    m = F.col("messages")
    return ms.normalize(chats, "_inspected").select(
        "doc_id",
        m.isNotNull().alias("normalized"),
        F.size(m).cast("bigint").alias("n_messages"),
        F.md5(F.when(m.isNotNull(), ms.first_text_of(m, "user"))).alias("first_md5"),
        F.md5(ms.last_text(m)).alias("last_md5"),
    )


@query
def conversation_measures(spark, sf_dir):
    return (
        _facts(spark, sf_dir)
        .filter("normalized")
        .select("conv_id", "n_messages", "n_chars", "n_stripped", "n_script", "has_short")
    )


@query
def validate_target(spark, sf_dir):
    normal = _facts(spark, sf_dir).filter("normalized")
    return normal.select("conv_id", target_reason(ACCENTED, LIMITS).alias("reason"))


@query
def validate_other(spark, sf_dir):
    normal = _facts(spark, sf_dir).filter("normalized")
    return normal.select("conv_id", other_reason(ACCENTED, LIMITS).alias("reason"))


@query
def exchange_outcomes(spark, sf_dir):
    """Row-shaped conversations judged by the rule of their tier."""
    quotas = quota.quota_table(spark, 0)
    chats = src.exchanges(spark, sf_dir).withColumn(
        "_inspected", ms.inspect_typed(F.col("messages"))
    )
    measured = measures_of(ms.normalize(chats, "_inspected"), "messages", ACCENTED, LIMITS)
    judged = measured.withColumn("tier", src.tier()).join(F.broadcast(quotas), "tier")
    return (
        judged.select("tier", outcome(F.col("rule"), ACCENTED, LIMITS).alias("outcome"))
        .groupBy("tier", "outcome")
        .agg(F.count(F.lit(1)).alias("n"))
    )


# Quota, de-duplication, split


@query
def scanned_rows(spark, sf_dir):
    verdicts = _verdicts(spark, sf_dir, _quotas(spark, sf_dir))
    return verdicts.select("conv_id", "tier", "outcome", "draw_key", "selected")


@query
def tier_reason_counts(spark, sf_dir):
    return curate.reason_counts(_verdicts(spark, sf_dir, _quotas(spark, sf_dir)))


@query
def tier_quota_counts(spark, sf_dir):
    quotas = _quotas(spark, sf_dir)
    return curate.quota_counts(_verdicts(spark, sf_dir, quotas), quotas)


@query
def dedup_first_prompt(spark, sf_dir):
    """Every normalised conversation, first of those with the same opening kept."""
    turns = src.turns(spark, sf_dir)
    n = LIMITS.dedup_chars
    opening = openings(turns, conversation_facts(turns, ACCENTED, LIMITS), n)
    numbers = F.create_map(*[F.lit(x) for t in TIERS for x in (t.name, t.number)])
    keyed = opening.select(
        "conv_id",
        tx.prefix_key(F.col("opening"), n).alias("dedup_key"),
        numbers[src.tier()].alias("tier_no"),
        tx.draw_key(SEED, src.tier(), F.col("conv_id")).alias("draw_key"),
    )
    kept = order.keep_first(keyed, ["dedup_key"], ["tier_no", "draw_key", "conv_id"])
    return kept.select("conv_id", "dedup_key")


def _document_keys(spark, sf_dir):
    return src.table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        tx.prefix_key(F.col("text"), LIMITS.dedup_chars).alias("dedup_key"),
        tx.draw_key(SEED, "documents", F.col("doc_id")).alias("draw_key"),
    )


@query
def dedup_documents(spark, sf_dir):
    keyed = _document_keys(spark, sf_dir)
    return order.keep_first(keyed, ["dedup_key"], ["source", "draw_key", "doc_id"]).select(
        "doc_id", "dedup_key"
    )


@query
def dedup_document_counts(spark, sf_dir):
    return curate.key_counts(_document_keys(spark, sf_dir))


@query
def train_eval_split(spark, sf_dir):
    normal = _facts(spark, sf_dir).filter("normalized")
    keyed = normal.select("conv_id", tx.draw_key(SEED, "split", F.col("conv_id")).alias("split_key"))
    return quota.exact_split(materialize(keyed, "keyed"), LIMITS.eval_share).select(
        "conv_id", "split"
    )


@query
def split_sizes(spark, sf_dir):
    return curate.split_counts(_curated(spark, sf_dir).corpus)


@query
def curated_corpus(spark, sf_dir):
    m = F.col("messages")
    return _curated(spark, sf_dir).corpus.select(
        "conv_id",
        "tier",
        "split",
        F.size(m).cast("bigint").alias("n_messages"),
        F.md5(ms.joined_text(m)).alias("text_md5"),
    )


@query
def curated_rows(spark, sf_dir):
    """The same job over row-shaped conversations."""
    rows = src.exchanges(spark, sf_dir).select("id", src.tier().alias("tier"), "messages")
    corpus = curate.curate_rows(rows, _quotas(spark, sf_dir), ACCENTED, LIMITS).corpus
    return corpus.select(
        "id", "tier", "split", F.md5(ms.joined_text(F.col("messages"))).alias("text_md5")
    )


def _splits_with_shared_ids(spark, sf_dir):
    """A split per tier; ids are unique in each and occur in all of them."""
    chats = src.exchanges(spark, sf_dir).select("id", "conv_id", src.tier().alias("tier"), "messages")
    shared = chats.withColumn("id", src.shared_id()).drop("conv_id")
    return [shared.filter(F.col("tier") == tier.name) for tier in TIERS]


@query
def curated_splits(spark, sf_dir):
    """Splits whose ids overlap, curated as one table."""
    rows = tables.union_splits(*_splits_with_shared_ids(spark, sf_dir))
    corpus = curate.curate_rows(rows, _quotas(spark, sf_dir), ACCENTED, LIMITS).corpus
    return corpus.select(
        "id", "tier", "split", F.md5(ms.joined_text(F.col("messages"))).alias("text_md5")
    )


@query
def union_keys(spark, sf_dir):
    """A key that stays unique over splits whose ids overlap."""
    splits = _splits_with_shared_ids(spark, sf_dir)
    return tables.union_splits(*splits, key="row_key").select("row_key", "tier")


@query
def dedup_counts(spark, sf_dir):
    return curate.dedup_counts(_curated(spark, sf_dir))


@query
def final_mix(spark, sf_dir):
    return curate.tier_mix(_curated(spark, sf_dir).corpus)


@query
def final_language_mix(spark, sf_dir):
    return curate.language_mix(_curated(spark, sf_dir).corpus)


# JSONL


@query
def jsonl_roundtrip(spark, sf_dir):
    """Curate, write lines, read the run back and audit it."""
    root = fresh_path(spark, "corpus")
    jsonl.write_run(_curated(spark, sf_dir).corpus, root, "r1")
    audited = audits.audit_read(jsonl.read_run(spark, root, "r1"), ACCENTED)
    return audited.select("corpus", "line_no", "code", "n_messages", "has_script").groupBy(
        "corpus", "code"
    ).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.min("line_no").cast("bigint").alias("first_line"),
        F.max("line_no").cast("bigint").alias("last_line"),
        F.sum("n_messages").alias("n_messages"),
        F.count_if("has_script").alias("n_script"),
    )


@query
def read_back_prompts(spark, sf_dir):
    """User turns written as a prompt file and read again."""
    path = fresh_path(spark, "prompts")
    chats = src.exchanges(spark, sf_dir)
    asked = F.filter("messages", lambda x: x["role"] == "user")
    jsonl.write_jsonl(chats.select(asked.alias("messages")), path)
    prompt = ms.last_text(F.col("messages"))
    return jsonl.read_prompts(spark, path).select(
        F.md5(prompt).alias("prompt_md5"),
        tx.preview(prompt, 60).alias("preview"),
        F.size("messages").cast("bigint").alias("n_messages"),
    )


def _audited(spark, sf_dir):
    return audits.audit_numbered(src.numbered_lines(spark, sf_dir), ACCENTED)


@query
def format_audit_lines(spark, sf_dir):
    return _audited(spark, sf_dir).select(
        "corpus", "line_no", "code", F.col("msg_index").cast("bigint").alias("msg_index"),
        "detail", "n_messages", "has_script",
    )


@query
def format_audit_exchanges(spark, sf_dir):
    """Raw exchanges as lines: unanswered prompts and system turns are faults there."""
    lines = src.exchanges(spark, sf_dir).select(
        F.lit("exchanges.jsonl").alias("corpus"),
        F.col("id").alias("line_no"),
        ms.as_json_line(F.col("messages")).alias("line"),
    )
    return audits.audit_numbered(lines, ACCENTED).select("line_no", "code", "n_messages")


@query
def format_audit_summary(spark, sf_dir):
    return audits.audit_summary(_audited(spark, sf_dir))


@query
def format_audit_first_errors(spark, sf_dir):
    return audits.first_errors(_audited(spark, sf_dir)).select(
        "corpus", "line_no", "code", F.col("place").cast("bigint").alias("place")
    )


@query
def format_gate(spark, sf_dir):
    return audits.format_gate(_audited(spark, sf_dir))


# Token budget


@query
def token_distribution(spark, sf_dir):
    return audits.token_distribution(src.token_lines(spark, sf_dir), TOKEN_LIMITS)


@query
def token_over_limit(spark, sf_dir):
    return audits.over_limit(src.token_lines(spark, sf_dir), TOKEN_LIMITS).select(
        "corpus", "over", "line_no", "n_tokens"
    )


@query
def token_filter(spark, sf_dir):
    return audits.within_limit(src.token_lines(spark, sf_dir), TOKEN_LIMITS)


@query
def token_removed(spark, sf_dir):
    return audits.removed_counts(src.token_lines(spark, sf_dir), TOKEN_LIMITS)


@query
def token_gate(spark, sf_dir):
    return audits.token_gate(src.token_lines(spark, sf_dir), TOKEN_LIMITS)


def _estimate(text):
    return audits.estimated_tokens(text, ACCENTED)


@query
def token_audit_of_lines(spark, sf_dir):
    """A corpus written as lines, read back and counted."""
    root = fresh_path(spark, "corpus")
    answered = F.when(F.size("messages") > 1, "train").otherwise("eval")
    jsonl.write_run(src.exchanges(spark, sf_dir).withColumn("split", answered), root, "r1")
    counted = audits.count_read(jsonl.read_run(spark, root, "r1"), _estimate)
    return audits.token_distribution(counted, TOKEN_LIMITS)


@query
def token_rewrite(spark, sf_dir):
    """A written corpus filtered in place: lines before and after."""
    path = fresh_path(spark, "rewrite-me")
    jsonl.write_jsonl(src.exchanges(spark, sf_dir), path)
    n_before = spark.read.text(path).count()
    n_removed = audits.filter_corpus(spark, path, _estimate, TokenLimits(max=150))
    after = spark.read.text(path).agg(F.count(F.lit(1)).alias("n_after"))
    return after.select(
        F.lit(n_before).cast("bigint").alias("n_before"),
        "n_after",
        F.lit(n_removed).cast("bigint").alias("n_removed"),
    )


@query
def plugged_line_tokens(spark, sf_dir):
    """Written lines counted by a Python counter, with a chat template on top."""
    path = fresh_path(spark, "lines")
    jsonl.write_jsonl(src.exchanges(spark, sf_dir), path)
    pieces = audits.counter_udf(lambda: lambda text: text.count(" ") + 1)
    template = lambda n, m: audits.with_overhead(n, m, per_message=4, system_prompt=21)
    counted = audits.count_read(jsonl.read_lines(spark, path), pieces, template)
    return counted.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_lines"))


@query
def token_rewrite_run(spark, sf_dir):
    """A run filtered in place: splits stay, and so does the order of lines."""
    root = fresh_path(spark, "runs")
    answered = F.when(F.size("messages") > 1, "train").otherwise("eval")
    chats = src.exchanges(spark, sf_dir).withColumn("split", answered)
    jsonl.write_run(chats.repartitionByRange(4, "id").sortWithinPartitions("split", "id"), root, "r1")
    audits.filter_corpus(spark, f"{root}/run_id=r1", _estimate, TokenLimits(max=150))
    lines = materialize(jsonl.read_run(spark, root, "r1"), "lines")
    return jsonl.with_line_numbers(lines).select(
        "corpus",
        F.col("line_no").cast("bigint").alias("line_no"),
        F.md5(ms.conversation_text(ms.parse_messages(F.col("line")))).alias("text_md5"),
    )


@query
def exchange_tokens_with_template(spark, sf_dir):
    """Token counts with a chat template's overhead, its system prompt unless there is one."""
    m = F.col("messages")
    n = audits.estimated_tokens(ms.joined_text(m), ACCENTED)
    counted = audits.with_overhead(n, m, per_message=4, system_prompt=21)
    return src.exchanges(spark, sf_dir).select("id", counted.cast("bigint").alias("n_tokens"))


# Responses


def _scored(spark, sf_dir, variant):
    pairs = src.prompts_and_replies(spark, sf_dir)
    return scoring.score_responses(src.responses(pairs, variant), ACCENTED)


@query
def usable_prompts(spark, sf_dir):
    prompts = src.prompts_and_replies(spark, sf_dir).select("prompt_id", "prompt")
    return scoring.usable_prompts(prompts).select(
        "prompt_id", F.length("prompt").cast("bigint").alias("n_chars")
    )


@query
def eval_scores(spark, sf_dir):
    return _scored(spark, sf_dir, "adapter").select(
        "prompt_id",
        tx.preview(F.col("prompt"), 60).alias("prompt_preview"),
        tx.preview(F.col("response"), 120).alias("response_preview"),
        "is_target_prompt",
        "is_target_response",
        "n_chars",
        "time_seconds",
    )


@query
def eval_summary(spark, sf_dir):
    pairs = src.prompts_and_replies(spark, sf_dir)
    scored = scoring.score_responses(src.all_responses(pairs), ACCENTED)
    return scoring.score_summary(scored, ["variant"])


@query
def response_records(spark, sf_dir):
    """Scored responses written per variant as JSON records and read again."""
    path = fresh_path(spark, "records")
    pairs = src.prompts_and_replies(spark, sf_dir)
    scored = scoring.score_responses(src.all_responses(pairs), ACCENTED).drop("seconds")
    jsonl.write_records(scored, path, ["variant"])
    return (
        spark.read.schema(scored.schema).json(path)
        .groupBy("variant")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("n_chars"))
    )


@query
def ab_comparison(spark, sf_dir):
    return scoring.compare(_scored(spark, sf_dir, "base"), _scored(spark, sf_dir, "adapter"))


@query
def ab_summary(spark, sf_dir):
    compared = scoring.compare(_scored(spark, sf_dir, "base"), _scored(spark, sf_dir, "adapter"))
    return scoring.compare_summary(compared)


# Packing


def _packable(spark, sf_dir):
    counted = src.token_lines(spark, sf_dir)
    return counted.select(
        F.col("line_no").alias("conv_id"),
        "n_tokens",
        tx.draw_key(SEED, "pack", F.col("line_no")).alias("draw_key"),
    )


PACK_CAPACITY = 1200
PACK_SHARDS = 7


@query
def packing_plan(spark, sf_dir):
    plan = packing.packing_plan(
        _packable(spark, sf_dir), "conv_id", PACK_CAPACITY, PACK_SHARDS
    )
    return plan.select("conv_id", "n_tokens", "shard", "bin", "oversized")


@query
def packing_report(spark, sf_dir):
    plan = packing.packing_plan(
        _packable(spark, sf_dir), "conv_id", PACK_CAPACITY, PACK_SHARDS
    )
    return packing.packing_report(plan, PACK_CAPACITY)


# Sources and sinks


@query
def save_modes(spark, sf_dir):
    """Saving where something already is changes nothing."""
    path = fresh_path(spark, "saved")
    documents = src.table(spark, sf_dir, "documents")
    tables.save_if_absent(documents.select("doc_id", "lang"), path)
    tables.save_if_absent(src.table(spark, sf_dir, "benchmark"), path)
    return tables.load_split(spark, path).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query
def merged_load(spark, sf_dir):
    """Files of one split with different columns, picked by name and read as one table."""
    root = fresh_path(spark, "mixed")
    documents = src.table(spark, sf_dir, "documents")
    tables.save_if_absent(documents.select("doc_id", "lang"), f"{root}/a_train.parquet")
    tables.save_if_absent(documents.select("doc_id", "source"), f"{root}/b_train.parquet")
    merged = tables.load_matching(spark, root, "*train*.parquet")
    return merged.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))


@query
def run_layout(spark, sf_dir):
    """Two runs side by side; each is read by its own key."""
    root = fresh_path(spark, "runs")
    chats = src.exchanges(spark, sf_dir).withColumn(
        "split", F.when(F.size("messages") > 1, "train").otherwise("eval")
    )
    jsonl.write_run(chats, root, "a")
    jsonl.write_run(chats.filter("split = 'train'"), root, "b")
    parts = [
        jsonl.read_run(spark, root, run, split).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(run).alias("run_id"), F.lit(split).alias("split"), "n"
        )
        for run, split in (("a", "train"), ("a", "eval"), ("b", "train"))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# Directories, nested lines and types that differ


@query
def nested_lines(spark, sf_dir):
    """Lines nested up to 20,000 levels deep: those past the limit have a code of their own."""
    audited = audits.audit_numbered(src.nested_lines(spark, sf_dir), ACCENTED)
    return audited.select(F.col("line_no").alias("doc_id"), "code", "detail", "n_messages")


def _directory(spark, sf_dir):
    """A folder with a corpus of answered chats, one of others and one without lines."""
    root = fresh_path(spark, "directory")
    name = F.when(F.size("messages") > 1, "train.jsonl").otherwise("other/eval.jsonl")
    chats = src.exchanges(spark, sf_dir).select(name.alias("corpus"), ms.as_json_line(F.col("messages")).alias("line"))
    jsonl.write_corpora(chats, root, ["none.jsonl"])
    return root


@query
def audit_of_directory(spark, sf_dir):
    """Format report of every file in a folder, those without lines included."""
    root = _directory(spark, sf_dir)
    audited = audits.audit_read(jsonl.read_lines(spark, root), ACCENTED)
    report = audits.audit_summary(audited, jsonl.corpora(spark, root))
    return report.select("corpus", "n_valid", "n_errors", "n_script", "n_other", "mean_turns")


@query
def tokens_of_directory(spark, sf_dir):
    root = _directory(spark, sf_dir)
    counted = audits.count_read(jsonl.read_lines(spark, root), _estimate)
    return audits.token_distribution(counted, TOKEN_LIMITS, jsonl.corpora(spark, root))


@query
def token_rewrite_directory(spark, sf_dir):
    """A folder filtered in place: lines taken out and left, per file."""
    root = _directory(spark, sf_dir)
    removed = audits.filter_files(spark, root, _estimate, TokenLimits(max=150))
    left = jsonl.read_lines(spark, root).groupBy("corpus").agg(F.count(F.lit(1)).alias("n_left"))
    return removed.join(left, "corpus", "left").fillna(0, ["n_left"])


@query
def rendered_line_tokens(spark, sf_dir):
    """Written lines counted over their messages as a template renders them."""
    path = fresh_path(spark, "lines")
    jsonl.write_jsonl(src.exchanges(spark, sf_dir), path)
    counter = audits.message_counter_udf(_load_rendered_counter)
    counted = audits.count_rendered(jsonl.read_lines(spark, path), counter)
    return counted.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_lines"))


def _load_rendered_counter():
    def count(messages):
        rendered = " ".join(f"<{role}> {content}" for role, content in messages) + " <assistant>"
        return rendered.count(" ") + 1

    return count


@query
def mixed_types_union(spark, sf_dir):
    """Splits of which one has typed messages and numbers as ids, one JSON text and text ids, and one
    JSON text in a table of VARIANT values."""
    chats = src.exchanges(spark, sf_dir).select("id", "conv_id", "messages")
    m, own = F.col("messages"), F.col("conv_id") % 3
    splits = [
        chats.filter(own == 0).select("id", "messages"),
        chats.filter(own == 1).select(F.col("id").cast("string").alias("id"), F.to_json(m).alias("messages")),
        chats.filter(own == 2).select("id", F.to_variant_object(m).alias("messages")),
    ]
    normal = curate.normalized_rows(tables.union_splits(*splits))
    return normal.select("id", F.md5(ms.joined_text(m)).alias("text_md5"))


@query
def merged_load_types(spark, sf_dir):
    """Files of one split whose columns have one name and different types."""
    root = fresh_path(spark, "types")
    documents = src.table(spark, sf_dir, "documents")
    kinds = [("bigint", "bigint"), ("string", "int"), ("int", "double")]
    for place, (ident, size) in enumerate(kinds):
        part = documents.filter(F.col("doc_id") % len(kinds) == place)
        columns = [F.col("doc_id").cast(ident).alias("doc_id"), F.col("n_chars").cast(size).alias("n_chars")]
        tables.save_if_absent(part.select(*columns), f"{root}/{place}_train.parquet")
    return tables.load_matching(spark, root, "*train*.parquet").select("doc_id", "n_chars")


@query
def curated_json(spark, sf_dir):
    """Conversations as JSON text, some of them no conversations, curated."""
    chats = src.chat_json(spark, sf_dir).withColumn("conv_id", F.col("doc_id"))
    rows = chats.select(F.col("doc_id").alias("id"), src.tier().alias("tier"), F.col("json").alias("messages"))
    quotas = quota.quota_table(spark, rows.count() // 5)
    corpus = curate.curate_rows(rows, quotas, ACCENTED, LIMITS).corpus
    return corpus.select("id", "tier", "split", F.md5(ms.joined_text(F.col("messages"))).alias("text_md5"))


@query
def packing_in_order(spark, sf_dir):
    """Next-fit over all rows in one order."""
    return nextfit.next_fit(_packable(spark, sf_dir), "conv_id", PACK_CAPACITY)


@query
def sample_head_that_cuts(spark, sf_dir):
    """The first row of each class among the first 40, which not all classes are in."""
    tagged = src.tag(src.conversation_ids(spark, sf_dir))
    return profile.sample_by_class(tagged.filter(F.col("conv_id") % 3 > 0), n=40)
