"""The registered queries in DuckDB SQL.

Written from the rules, not from the Spark plans: conversations are put together whole here,
texts are joined and measured as texts, and ranks come from plain window functions.
"""

from __future__ import annotations

from registry.inputs import CHAT_SHAPES, LINE_SHAPES

_CODES = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
          0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
WS = "||".join(f"chr({c})" for c in _CODES)
CLASS = r"[\x{00C0}-\x{024F}]"
NOT_CLASS = r"[^\x{00C0}-\x{024F}]"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def n_script(x: str) -> str:
    return f"length(regexp_replace({x}, '{NOT_CLASS}', '', 'g'))"


def has_script(x: str) -> str:
    return f"regexp_matches({x}, '{CLASS}')"


def ratio(x: str) -> str:
    return (
        f"CASE WHEN length({strip(x)}) > 0 THEN {n_script(x)}::DOUBLE / length({strip(x)}) "
        f"ELSE 0::DOUBLE END"
    )


def tokens(n: str, s: str) -> str:
    return f"CAST(trunc(({s})::DOUBLE / 2.5::DOUBLE + (({n}) - ({s}))::DOUBLE / 4.0::DOUBLE) AS BIGINT)"


def pct(a: str, b: str) -> str:
    return f"(100::DOUBLE * ({a}) / nullif({b}, 0))"


DATASET = (
    "CASE WHEN conv_id % 5 = 2 THEN CASE WHEN conv_id % 2 = 0 THEN 'sovereign_messages' "
    "ELSE 'sovereign_prompt' END ELSE 'sft' END"
)
SOURCE = (
    "CASE WHEN conv_id % 5 = 2 THEN NULL WHEN conv_id % 5 IN (0, 1) THEN 'autoif' "
    "WHEN conv_id % 3 = 1 THEN '' WHEN conv_id % 3 = 2 THEN 'ai2-mix' END"
)
TIER = (
    "CASE WHEN conv_id % 5 = 2 THEN 'sovereign' WHEN conv_id % 5 IN (0, 1) THEN 'autoif' "
    "ELSE 'tulu_sft_en' END"
)
TIER_NO = "CASE tier WHEN 'autoif' THEN 1 WHEN 'sovereign' THEN 2 ELSE 3 END"
TAGGED = f"""
ids AS (SELECT DISTINCT conv_id FROM conversations),
tagged AS (SELECT conv_id, {DATASET} AS dataset, {SOURCE} AS source, {TIER} AS tier FROM ids)"""

RAW = """
raw AS (SELECT conv_id, count(*) AS n_messages, string_agg(text, ' ' ORDER BY turn) AS txt
        FROM conversations GROUP BY conv_id)"""

NORMAL = f"""
t AS (SELECT conv_id, turn, role, text,
             text IS NOT NULL AND length({strip('text')}) > 0 AS spoken FROM conversations),
k AS (SELECT conv_id, turn, role, text, row_number() OVER w AS pos, lag(role) OVER w AS prev
      FROM t WHERE spoken AND role IN ('user', 'assistant')
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
shape AS (SELECT conv_id, min(turn) AS first_turn,
                 count(*) >= 2 AND arg_min(role, turn) = 'user'
                 AND arg_max(role, turn) = 'assistant'
                 AND count(*) FILTER (WHERE role = prev) = 0 AS good
          FROM k GROUP BY conv_id),
sys AS (SELECT t.conv_id, arg_max(text, turn) AS system
        FROM t JOIN shape ON t.conv_id = shape.conv_id
        WHERE spoken AND role = 'system' AND turn < first_turn GROUP BY t.conv_id),
msg AS (SELECT k.conv_id, k.turn, k.pos, k.role,
               CASE WHEN k.pos = 1 AND system IS NOT NULL
                    THEN system || chr(10) || chr(10) || k.text ELSE k.text END AS content
        FROM k JOIN shape ON k.conv_id = shape.conv_id AND shape.good
        LEFT JOIN sys ON sys.conv_id = k.conv_id),
norm AS (SELECT conv_id, count(*) AS n_messages, string_agg(content, ' ' ORDER BY pos) AS txt,
                min(length({strip('content')})) AS shortest, arg_min(content, pos) AS first_text
         FROM msg GROUP BY conv_id)"""


def reasons(txt: str, shortest: str) -> tuple[str, str]:
    size = (
        f"WHEN {tokens(f'length({txt})', n_script(txt))} > 2000 THEN 'too_long' "
        f"WHEN {shortest} < 5 THEN 'empty_message' ELSE 'ok' END"
    )
    target = (
        f"CASE WHEN NOT {has_script(txt)} THEN 'no_accented' "
        f"WHEN {ratio(txt)} < 0.05::DOUBLE THEN 'accented_ratio_low' {size}"
    )
    other = f"CASE WHEN {has_script(txt)} THEN 'has_accented' {size}"
    return target, other


TARGET, OTHER = reasons("txt", "shortest")


def outcome() -> str:
    return (
        f"CASE WHEN txt IS NULL THEN 'normalize_failed' "
        f"WHEN tier = 'tulu_sft_en' THEN replace('invalid_' || ({OTHER}), 'invalid_ok', 'accepted') "
        f"ELSE replace('invalid_' || ({TARGET}), 'invalid_ok', 'accepted') END"
    )


def curation(all_rows: str, ident: str, total: str) -> str:
    """CTEs from `all_rows` (ident, tier, txt, shortest, first_text, n_messages) to `final`.
    A row is known by tier and ident together."""
    return f"""
total AS (SELECT {total} AS n),
v AS (SELECT *, {TIER_NO} AS tier_no, md5('42:' || tier || ':' || {ident}) AS draw_key,
             {outcome()} AS outcome,
             CAST(trunc((SELECT n FROM total)
                        * CASE tier WHEN 'sovereign' THEN 0.2::DOUBLE ELSE 0.4::DOUBLE END)
                  AS BIGINT) AS target
      FROM {all_rows}),
ranked AS (SELECT *, coalesce(count(*) FILTER (WHERE outcome = 'accepted') OVER
                     (PARTITION BY tier ORDER BY draw_key, {ident}
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken_before
           FROM v),
marked AS (SELECT *, taken_before < target AS scanned,
                  taken_before < target AND outcome = 'accepted' AS selected FROM ranked),
collected AS (SELECT *, md5(substring(first_text, 1, 500)) AS dedup_key FROM marked WHERE selected),
uniq AS (SELECT *, md5('42:split:' || {ident}) AS split_key FROM
         (SELECT *, row_number() OVER (PARTITION BY dedup_key
                                       ORDER BY tier_no, draw_key, {ident}) AS r FROM collected)
         WHERE r = 1),
final AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY split_key, {ident}, tier)
                         <= (SELECT CAST(trunc(count(*) * 0.2::DOUBLE) AS BIGINT) FROM uniq)
                    THEN 'eval' ELSE 'train' END AS split FROM uniq)"""


CONV_TOTAL = "(SELECT count(DISTINCT conv_id) // 5 FROM conversations)"
JUDGED = f"""
all_rows AS (SELECT tagged.conv_id, tier, txt, shortest, first_text, n_messages
             FROM tagged LEFT JOIN norm ON tagged.conv_id = norm.conv_id)"""
CURATED = f"WITH {TAGGED}, {NORMAL}, {JUDGED}, {curation('all_rows', 'conv_id', CONV_TOTAL)}"

# One row per user turn with its neighbours.
EXCHANGES = """
x AS (SELECT u.conv_id * 4294967296 + u.turn AS id, u.conv_id, u.text AS asked,
             s.text AS system, a.text AS reply, b.text AS reply_before
      FROM conversations u
      LEFT JOIN conversations s ON s.conv_id = u.conv_id AND s.turn = u.turn - 1 AND s.role = 'system'
      LEFT JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
      LEFT JOIN conversations b ON b.conv_id = u.conv_id AND b.turn = u.turn - 1 AND b.role = 'assistant'
      WHERE u.role = 'user')"""
X_TEXT = "concat_ws(' ', system, asked, reply)"
X_FIRST = "concat_ws(chr(10) || chr(10), system, asked)"
# Exchanges as normalised conversations; every text of the table is spoken (checked below).
X_NORMAL = f"""
xs AS (SELECT *, system IS NOT NULL AND length({strip('system')}) > 0 AS s_ok,
              length({strip('asked')}) > 0 AS q_ok,
              reply IS NOT NULL AND length({strip('reply')}) > 0 AS r_ok FROM x),
xn AS (SELECT id, conv_id, {TIER} AS tier,
              CASE WHEN s_ok THEN system || chr(10) || chr(10) || asked ELSE asked END AS first_text,
              reply, q_ok AND r_ok AS good, 2 AS n_messages FROM xs),
x_rows AS (SELECT id, conv_id, tier, n_messages,
                  CASE WHEN good THEN first_text END AS first_text,
                  CASE WHEN good THEN first_text || ' ' || reply END AS txt,
                  CASE WHEN good THEN least(length({strip('first_text')}), length({strip('reply')})) END AS shortest
           FROM xn)"""

# An id that exchanges of different tiers share.
SHARED_ID = (
    "(conv_id // 5 * 2 + CASE WHEN conv_id % 5 IN (1, 4) THEN 1 ELSE 0 END) * 4294967296 "
    "+ id % 4294967296"
)
TOKEN_LINES = f"""
{RAW},
lines AS (SELECT CASE WHEN conv_id % 5 = 0 THEN 'eval.jsonl' ELSE 'train.jsonl' END AS corpus,
                 conv_id AS line_no, {tokens('length(txt)', n_script('txt'))} AS n_tokens FROM raw)"""

# From `lines` (corpus, n_tokens).
DISTRIBUTION = """
s AS (SELECT corpus, list(n_tokens ORDER BY n_tokens) AS v, count(*) AS n, avg(n_tokens) AS mean,
             count(*) FILTER (WHERE n_tokens > 700 AND n_tokens <= 1000) AS over_warn,
             count(*) FILTER (WHERE n_tokens > 1000) AS over_max FROM lines GROUP BY corpus)
SELECT corpus, n, v[1] AS low, v[n] AS high, mean, v[n // 2 + 1] AS median,
       v[CAST(trunc(n * 0.9::DOUBLE) AS BIGINT) + 1] AS p90,
       v[CAST(trunc(n * 0.95::DOUBLE) AS BIGINT) + 1] AS p95,
       v[CAST(trunc(n * 0.99::DOUBLE) AS BIGINT) + 1] AS p99, over_warn, over_max FROM s"""

DIRECTORY = f"""
{EXCHANGES},
lines AS (SELECT *, CASE WHEN system IS NOT NULL OR reply IS NOT NULL THEN 'train.jsonl'
                         ELSE 'other/eval.jsonl' END AS corpus,
                 {X_TEXT} AS txt, {tokens(f'length({X_TEXT})', n_script(X_TEXT))} AS n_tokens FROM x)"""

# What each JSON shape of registry.inputs normalises to, by its number.
_SHAPE = f"doc_id % {len(CHAT_SHAPES)}"
REPLY = "'Re: ' || source"
CHAT_GOOD = f"({_SHAPE}) IN (0, 1, 2, 3, 4, 6, 7, 12, 13, 14) AND length({strip('text')}) > 0"
CHAT_FIRST = f"CASE WHEN ({_SHAPE}) IN (1, 2) THEN {REPLY} || chr(10) || chr(10) || text ELSE text END"
CHAT_TEXT = f"""CASE ({_SHAPE})
  WHEN 0 THEN text || ' ' || {REPLY}
  WHEN 1 THEN {REPLY} || ' ' || text || ' ' || {REPLY}
  WHEN 2 THEN text || ' ' || {REPLY} || ' ' || text || ' ' || {REPLY}
  WHEN 3 THEN text || ' ' || {REPLY} || ' ' || {REPLY}
  WHEN 4 THEN '   ' || text || ' ' || {REPLY}
  WHEN 5 THEN text || ' '
  WHEN 6 THEN text || ' ' || {REPLY}
  WHEN 7 THEN text || ' ' || {REPLY} || ' ' || {REPLY}
  WHEN 8 THEN text || ' ' || {REPLY} || ' ' || text
  WHEN 9 THEN text || ' ' || text
  WHEN 10 THEN text || ' ' || text || ' ' || {REPLY}
  WHEN 11 THEN ''
  WHEN 12 THEN text || ' ' || {REPLY}
  WHEN 13 THEN text || ' ' || {REPLY}
  WHEN 14 THEN text || ' ' || text || ' ' || {REPLY}
  ELSE text END"""
CHAT_ITEMS = f"""CASE ({_SHAPE}) WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 4 WHEN 3 THEN 3 WHEN 4 THEN 3
  WHEN 5 THEN 2 WHEN 6 THEN 2 WHEN 7 THEN 3 WHEN 8 THEN 3 WHEN 9 THEN 2 WHEN 10 THEN 3 WHEN 12 THEN 3
  WHEN 13 THEN 3 WHEN 14 THEN 3 END"""
CHAT_PREVIEW = f"""CASE WHEN ({_SHAPE}) IN (9, 11, 15) THEN NULL WHEN ({_SHAPE}) = 12 THEN '5'
  WHEN ({_SHAPE}) = 4 THEN '  ' WHEN ({_SHAPE}) = 1 THEN substring({REPLY}, 1, 150)
  ELSE substring(text, 1, 150) END"""

_LINE = f"doc_id % {len(LINE_SHAPES)}"
AUDITED = f"""
a AS (SELECT lang || '.jsonl' AS corpus, doc_id + 1 AS line_no, text, source, {_LINE} AS shape
      FROM documents),
audited AS (
  SELECT corpus, line_no, text, source, shape,
    CASE shape WHEN 0 THEN 'valid' WHEN 2 THEN 'invalid_json' WHEN 3 THEN 'not_list'
      WHEN 4 THEN 'too_few' WHEN 5 THEN 'msg_not_dict' WHEN 6 THEN 'missing_key'
      WHEN 7 THEN 'bad_role' WHEN 8 THEN 'empty_content' WHEN 9 THEN 'bad_start'
      WHEN 10 THEN 'bad_end' ELSE 'non_alternating' END AS code,
    CASE WHEN shape IN (5, 6, 7, 11) THEN 0 WHEN shape = 8 THEN 1 END::BIGINT AS msg_index,
    CASE shape WHEN 3 THEN 'dict' WHEN 4 THEN '1' WHEN 7 THEN 'system' END AS detail,
    CASE WHEN shape = 4 THEN 1 WHEN shape IN (10, 11) THEN 3
         WHEN shape IN (0, 5, 6, 7, 8, 9) THEN 2 END::BIGINT AS n_messages,
    CASE WHEN shape = 0 THEN {has_script(f"text || ' ' || {REPLY}")} END AS has_script
  FROM a WHERE shape <> 1)"""

PAIRS = f"""
{EXCHANGES},
r AS (SELECT id AS prompt_id, 'adapter' AS variant, asked AS prompt, reply AS response FROM x WHERE reply IS NOT NULL
      UNION ALL
      SELECT id, 'base', asked, reply_before FROM x WHERE reply_before IS NOT NULL),
scored AS (SELECT *, {has_script('prompt')} AS tp, {has_script('response')} AS tr,
                  length(response) AS n_chars, length(response) / 100::DOUBLE AS seconds FROM r)"""
COMPARED = f"""
{PAIRS},
b AS (SELECT * FROM scored WHERE variant = 'base'),
d AS (SELECT * FROM scored WHERE variant = 'adapter'),
compared AS (
  SELECT coalesce(b.prompt_id, d.prompt_id) AS prompt_id, coalesce(b.tp, d.tp) AS is_target_prompt,
    b.tp = b.tr AS base_kept, d.tp = d.tr AS adapted_kept,
    b.n_chars AS base_n_chars, d.n_chars AS adapted_n_chars, d.n_chars - b.n_chars AS n_chars_delta,
    round(d.seconds, 2) - round(b.seconds, 2) AS seconds_delta,
    CASE WHEN b.prompt_id IS NULL THEN 'adapted_only' WHEN d.prompt_id IS NULL THEN 'base_only'
         ELSE 'both' END AS present
  FROM b FULL OUTER JOIN d ON b.prompt_id = d.prompt_id)"""

HEAD = f"""
{TAGGED},
head AS (SELECT * FROM tagged ORDER BY conv_id LIMIT 10000),
flagged AS (SELECT conv_id, bool_or({has_script('text')}) AS has_script FROM conversations
            WHERE conv_id IN (SELECT conv_id FROM head) GROUP BY conv_id)"""
SAMPLES = f"""
{TAGGED},
classed AS (SELECT conv_id, source,
                   CASE WHEN coalesce(source, '') = 'autoif' THEN 'autoif'
                        WHEN coalesce(source, '') = '' THEN 'empty'
                        WHEN source LIKE 'ai2%' THEN 'ai2' END AS class
            FROM (SELECT * FROM tagged WHERE dataset = 'sft' ORDER BY conv_id LIMIT 1000)),
samples AS (SELECT min(conv_id) AS conv_id, class FROM classed WHERE class IS NOT NULL GROUP BY class),
firsts AS (SELECT dataset, min(conv_id) AS conv_id FROM tagged WHERE dataset <> 'sft' GROUP BY dataset)"""

PACKED = f"""
{TOKEN_LINES},
keyed AS (SELECT line_no AS conv_id, n_tokens, md5('42:pack:' || line_no) AS draw_key,
                 7::DOUBLE AS shards FROM lines),
placed AS (SELECT conv_id, n_tokens, draw_key,
                  CAST(floor(CAST('0x' || substring(draw_key, 1, 12) AS BIGINT)::DOUBLE * shards
                             / 281474976710656::DOUBLE) AS BIGINT) AS shard FROM keyed),
numbered AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY draw_key, conv_id) AS pos FROM placed),
walk AS (
  SELECT shard, pos, conv_id, n_tokens, 0::BIGINT AS bin, n_tokens AS used FROM numbered WHERE pos = 1
  UNION ALL
  SELECT n.shard, n.pos, n.conv_id, n.n_tokens,
         CASE WHEN w.used + n.n_tokens <= 1200 THEN w.bin ELSE w.bin + 1 END,
         CASE WHEN w.used + n.n_tokens <= 1200 THEN w.used + n.n_tokens ELSE n.n_tokens END
  FROM walk w JOIN numbered n ON n.shard = w.shard AND n.pos = w.pos + 1)"""

ORACLE: dict[str, str] = {
    "script_stats": f"""
SELECT doc_id, length(text) AS n_chars, length({strip('text')}) AS n_stripped,
       {has_script('text')} AS has_script, {n_script('text')} AS n_script, {ratio('text')} AS ratio,
       {tokens('length(text)', n_script('text'))} AS n_tokens,
       length({strip('text')}) > 0 AS is_spoken, md5(substring(text, 1, 500)) AS prefix_key,
       substring(text, 1, 60) AS preview FROM documents""",
    "plugged_token_counts": """
SELECT doc_id, length(text) - length(replace(text, ' ', '')) + 1 AS n_tokens FROM documents""",
    "conversation_text": f"""
WITH {RAW} SELECT conv_id, n_messages, length(txt) AS n_chars, {n_script('txt')} AS n_script,
       {has_script('txt')} AS has_script, substring(txt, 1, 150) AS opening FROM raw""",
    "exchange_text": f"""
WITH {EXCHANGES} SELECT id, md5({X_TEXT}) AS text_md5, length(asked) AS first_user_chars,
       substring(coalesce(reply, asked), 1, 120) AS last_preview,
       system IS NOT NULL AS starts_with_system FROM x""",
    "json_conversation_text": f"""
SELECT doc_id, ({CHAT_ITEMS})::BIGINT AS n_items, md5({CHAT_TEXT}) AS text_md5,
       {CHAT_PREVIEW} AS first_preview FROM documents""",
    "source_histogram": f"""
WITH {TAGGED} SELECT source, count(*) AS n,
       {pct('count(*)', "(SELECT count(*) FROM tagged WHERE dataset = 'sft')")} AS pct
FROM tagged WHERE dataset = 'sft' GROUP BY source""",
    "turn_stats": f"""
WITH {RAW} SELECT min(n_messages) AS min_messages, max(n_messages) AS max_messages,
       avg(n_messages) AS mean_messages FROM raw""",
    "row_turn_stats": f"""
WITH {EXCHANGES}, n AS (SELECT 1 + (system IS NOT NULL)::BIGINT + (reply IS NOT NULL)::BIGINT AS n FROM x)
SELECT min(n) AS min_messages, max(n) AS max_messages, avg(n) AS mean_messages FROM n""",
    "row_script_share": f"""
WITH {EXCHANGES}, f AS (SELECT {SOURCE} AS source, {has_script(X_TEXT)} AS has_script FROM x)
SELECT source, count(*) AS n_rows, count(*) FILTER (WHERE has_script) AS n_script,
       {pct('count(*) FILTER (WHERE has_script)', 'count(*)')} AS pct_script FROM f GROUP BY source""",
    "json_script_share": f"""
WITH f AS (SELECT {has_script('text')} AS has_script FROM documents)
SELECT 'unknown' AS source, count(*) AS n_rows, count(*) FILTER (WHERE has_script) AS n_script,
       {pct('count(*) FILTER (WHERE has_script)', 'count(*)')} AS pct_script FROM f""",
    "row_sample_messages": f"""
WITH {EXCHANGES},
classed AS (SELECT id, system, asked, reply,
                   CASE WHEN coalesce(source, '') = 'autoif' THEN 'autoif'
                        WHEN coalesce(source, '') = '' THEN 'empty'
                        WHEN source LIKE 'ai2%' THEN 'ai2' END AS class
            FROM (SELECT *, {SOURCE} AS source FROM x WHERE {DATASET} = 'sft' ORDER BY id LIMIT 1000)),
first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY class ORDER BY id) AS r
                         FROM classed WHERE class IS NOT NULL) WHERE r = 1),
shown AS (SELECT id, 0 AS o, 'system' AS role, system AS text FROM first
          UNION ALL SELECT id, 1, 'user', asked FROM first
          UNION ALL SELECT id, 2, 'assistant', reply FROM first)
SELECT id, row_number() OVER (PARTITION BY id ORDER BY o) AS place, role,
       substring(text, 1, 150) AS preview FROM shown WHERE text IS NOT NULL""",
    "script_share_first_n": f"""
WITH {HEAD} SELECT count(*) AS n_rows, count(*) FILTER (WHERE has_script) AS n_script,
       {pct('count(*) FILTER (WHERE has_script)', 'count(*)')} AS pct_script FROM flagged""",
    "script_share_by_source": f"""
WITH {HEAD} SELECT source, count(*) AS n_rows, count(*) FILTER (WHERE has_script) AS n_script,
       {pct('count(*) FILTER (WHERE has_script)', 'count(*)')} AS pct_script
FROM flagged JOIN head USING (conv_id) GROUP BY source""",
    "script_share_first_stored": f"""
WITH head AS (SELECT * FROM documents ORDER BY doc_id LIMIT 10000)
SELECT source, count(*) AS n_rows, count(*) FILTER (WHERE {has_script('text')}) AS n_script,
       {pct(f"count(*) FILTER (WHERE {has_script('text')})", 'count(*)')} AS pct_script
FROM head GROUP BY source""",
    "head_that_cuts": f"""
WITH {RAW} SELECT conv_id, {has_script('txt')} AS has_script FROM raw ORDER BY conv_id LIMIT 15""",
    "stored_head_that_cuts": "SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 150",
    "short_segments": f"""
WITH {NORMAL} SELECT conv_id, n_messages, length(txt) AS n_chars, length({strip('txt')}) AS n_stripped,
       {n_script('txt')} AS n_script, shortest < 5 AS has_short FROM norm""",
    "sample_by_class": f"""
WITH {SAMPLES} SELECT samples.conv_id, source, samples.class FROM samples JOIN classed
  ON samples.conv_id = classed.conv_id""",
    "first_of_each_split": f"WITH {SAMPLES} SELECT dataset, conv_id FROM firsts",
    "sample_messages": f"""
WITH {SAMPLES},
shown AS (SELECT conv_id FROM samples UNION ALL SELECT conv_id FROM firsts),
m AS (SELECT c.conv_id, row_number() OVER (PARTITION BY c.conv_id ORDER BY turn) AS place, role,
             substring(text, 1, 150) AS preview FROM conversations c JOIN shown USING (conv_id))
SELECT * FROM m WHERE place <= 4""",
    "split_inventory": """
SELECT 'conversations' AS name, true AS present, count(*) AS n_rows, 'conv_id,turn,role,text' AS columns FROM conversations
UNION ALL SELECT 'documents', true, count(*), 'doc_id,text,lang,source,n_chars' FROM documents
UNION ALL SELECT 'benchmark', true, count(*), 'item_id,text' FROM benchmark
UNION ALL SELECT 'not_there', false, NULL, NULL""",
    "tier_assignment": f"""
WITH {TAGGED} SELECT dataset, source, tier, count(*) AS n FROM tagged GROUP BY ALL""",
    "sovereign_union": f"""
WITH {EXCHANGES}, d AS (SELECT *, {DATASET} AS dataset FROM x)
SELECT id, CASE WHEN dataset = 'sovereign_prompt' THEN dataset END AS origin,
       1 + (system IS NOT NULL)::BIGINT + (reply IS NOT NULL)::BIGINT AS n_messages,
       md5({X_TEXT}) AS text_md5
FROM d WHERE dataset = 'sovereign_messages'
   OR (dataset = 'sovereign_prompt' AND (system IS NOT NULL OR reply IS NOT NULL))""",
    "first_present_column": f"""
WITH {EXCHANGES}
SELECT id, 1 + (system IS NOT NULL)::BIGINT + (reply IS NOT NULL)::BIGINT AS n_messages,
       md5(coalesce(reply, asked)) AS last_md5 FROM x""",
    "normalized_conversations": f"""
WITH {NORMAL} SELECT conv_id, turn, role, length(content) AS n_chars, md5(content) AS content_md5 FROM msg""",
    "normalize_json": f"""
SELECT doc_id, {CHAT_GOOD} AS normalized, CASE WHEN {CHAT_GOOD} THEN 2 END::BIGINT AS n_messages,
       CASE WHEN {CHAT_GOOD} THEN md5({CHAT_FIRST}) END AS first_md5,
       CASE WHEN {CHAT_GOOD} THEN md5({REPLY}) END AS last_md5 FROM documents""",
    "conversation_measures": f"""
WITH {NORMAL} SELECT conv_id, n_messages, length(txt) AS n_chars, length({strip('txt')}) AS n_stripped,
       {n_script('txt')} AS n_script, shortest < 5 AS has_short FROM norm""",
    "validate_target": f"WITH {NORMAL} SELECT conv_id, {TARGET} AS reason FROM norm",
    "validate_other": f"WITH {NORMAL} SELECT conv_id, {OTHER} AS reason FROM norm",
    "exchange_outcomes": f"""
WITH {EXCHANGES}, {X_NORMAL}
SELECT tier, outcome, count(*) AS n FROM (SELECT tier, {outcome()} AS outcome FROM x_rows) GROUP BY ALL""",
    "scanned_rows": f"{CURATED} SELECT conv_id, tier, outcome, draw_key, selected FROM marked WHERE scanned",
    "tier_reason_counts": f"""
{CURATED} SELECT tier, outcome, count(*) AS n FROM marked WHERE scanned GROUP BY tier, outcome""",
    "tier_quota_counts": f"""
{CURATED} SELECT tier, any_value(target) AS target, count(*) FILTER (WHERE selected) AS collected
FROM marked GROUP BY tier""",
    "dedup_first_prompt": f"""
WITH {TAGGED}, {NORMAL},
keyed AS (SELECT norm.conv_id, md5(substring(first_text, 1, 500)) AS dedup_key, {TIER_NO} AS tier_no,
                 md5('42:' || tier || ':' || norm.conv_id) AS draw_key
          FROM norm JOIN tagged ON norm.conv_id = tagged.conv_id)
SELECT conv_id, dedup_key FROM (SELECT *, row_number() OVER (PARTITION BY dedup_key
  ORDER BY tier_no, draw_key, conv_id) AS r FROM keyed) WHERE r = 1""",
    "dedup_documents": """
SELECT doc_id, dedup_key FROM (
  SELECT doc_id, md5(substring(text, 1, 500)) AS dedup_key,
         row_number() OVER (PARTITION BY md5(substring(text, 1, 500))
                            ORDER BY source, md5('42:documents:' || doc_id), doc_id) AS r
  FROM documents) WHERE r = 1""",
    "dedup_document_counts": """
SELECT count(*) AS n_before, count(DISTINCT md5(substring(text, 1, 500))) AS n_after FROM documents""",
    "train_eval_split": f"""
WITH {NORMAL}
SELECT conv_id, CASE WHEN row_number() OVER (ORDER BY md5('42:split:' || conv_id), conv_id)
                     <= (SELECT CAST(trunc(count(*) * 0.2::DOUBLE) AS BIGINT) FROM norm)
                THEN 'eval' ELSE 'train' END AS split FROM norm""",
    "split_sizes": f"{CURATED} SELECT split, count(*) AS n FROM final GROUP BY split",
    "curated_corpus": f"""
{CURATED} SELECT conv_id, tier, split, n_messages, md5(txt) AS text_md5 FROM final""",
    "curated_rows": f"""
WITH {EXCHANGES}, {X_NORMAL}, {curation('x_rows', 'id', CONV_TOTAL)}
SELECT id, tier, split, md5(txt) AS text_md5 FROM final""",
    "curated_splits": f"""
WITH {EXCHANGES}, {X_NORMAL},
shared AS (SELECT * REPLACE ({SHARED_ID} AS id) FROM x_rows),
{curation('shared', 'id', CONV_TOTAL)}
SELECT id, tier, split, md5(txt) AS text_md5 FROM final""",
    "union_keys": f"""
WITH {EXCHANGES}, {X_NORMAL}
SELECT CASE tier WHEN 'autoif' THEN '0:' WHEN 'sovereign' THEN '1:' ELSE '2:' END
       || CAST({SHARED_ID} AS VARCHAR) AS row_key, tier FROM x_rows""",
    "dedup_counts": f"""
{CURATED} SELECT count(*) AS n_before, count(DISTINCT dedup_key) AS n_after FROM collected""",
    "final_mix": f"""
{CURATED} SELECT tier, count(*) AS n, {pct('count(*)', '(SELECT count(*) FROM final)')} AS pct
FROM final GROUP BY tier""",
    "final_language_mix": f"""
{CURATED} SELECT CASE WHEN tier = 'tulu_sft_en' THEN 'other' ELSE 'target' END AS language,
       count(*) AS n, {pct('count(*)', '(SELECT count(*) FROM final)')} AS pct FROM final GROUP BY 1""",
    "jsonl_roundtrip": f"""
{CURATED} SELECT split AS corpus, 'valid' AS code, count(*) AS n_lines, 1::BIGINT AS first_line,
       count(*) AS last_line, sum(n_messages)::BIGINT AS n_messages,
       count(*) FILTER (WHERE {has_script('txt')}) AS n_script FROM final GROUP BY split""",
    "read_back_prompts": f"""
WITH {EXCHANGES} SELECT md5(asked) AS prompt_md5, substring(asked, 1, 60) AS preview,
       1::BIGINT AS n_messages FROM x""",
    "format_audit_lines": f"""
WITH {AUDITED} SELECT corpus, line_no, code, msg_index, detail, n_messages, has_script FROM audited""",
    "format_audit_exchanges": f"""
WITH {EXCHANGES}
SELECT id AS line_no, 1 + (system IS NOT NULL)::BIGINT + (reply IS NOT NULL)::BIGINT AS n_messages,
       CASE WHEN system IS NULL AND reply IS NULL THEN 'too_few' WHEN system IS NOT NULL THEN 'bad_role'
            ELSE 'valid' END AS code FROM x""",
    "format_audit_summary": f"""
WITH {AUDITED},
c AS (SELECT corpus, count(*) FILTER (WHERE code = 'valid') AS n_valid,
             count(*) FILTER (WHERE code <> 'valid') AS n_errors,
             count(*) FILTER (WHERE code = 'valid' AND has_script) AS n_script,
             avg(n_messages) FILTER (WHERE code = 'valid') AS mean_turns FROM audited GROUP BY corpus)
SELECT corpus, n_valid, n_errors, n_script, n_valid - n_script AS n_other,
       {pct('n_script', 'n_valid')} AS pct_script, {pct('n_valid - n_script', 'n_valid')} AS pct_other,
       mean_turns FROM c""",
    "format_audit_first_errors": f"""
WITH {AUDITED}
SELECT corpus, line_no, code, place FROM (
  SELECT corpus, line_no, code, row_number() OVER (PARTITION BY corpus ORDER BY line_no) AS place
  FROM audited WHERE code <> 'valid') WHERE place <= 10""",
    "format_gate": f"""
WITH {AUDITED} SELECT count(*) FILTER (WHERE code <> 'valid') AS n_errors,
       count(*) FILTER (WHERE code <> 'valid') = 0 AS passed FROM audited""",
    "token_distribution": f"""
WITH {TOKEN_LINES}, {DISTRIBUTION}""",
    "token_audit_of_lines": f"""
WITH {EXCHANGES},
lines AS (SELECT CASE WHEN system IS NOT NULL OR reply IS NOT NULL THEN 'train' ELSE 'eval' END AS corpus,
                 {tokens(f'length({X_TEXT})', n_script(X_TEXT))} AS n_tokens FROM x),
{DISTRIBUTION}""",
    "token_over_limit": f"""
WITH {TOKEN_LINES},
o AS (SELECT *, CASE WHEN n_tokens > 1000 THEN 'max' ELSE 'warn' END AS over FROM lines WHERE n_tokens > 700),
p AS (SELECT *, row_number() OVER (PARTITION BY corpus, over ORDER BY line_no) AS place FROM o)
SELECT corpus, over, line_no, n_tokens FROM p WHERE place <= CASE over WHEN 'max' THEN 20 ELSE 10 END""",
    "token_filter": f"WITH {TOKEN_LINES} SELECT * FROM lines WHERE n_tokens <= 1000",
    "token_removed": f"""
WITH {TOKEN_LINES} SELECT corpus, count(*) FILTER (WHERE n_tokens <= 1000) AS n_kept,
       count(*) FILTER (WHERE n_tokens > 1000) AS n_removed FROM lines GROUP BY corpus""",
    "token_gate": f"""
WITH {TOKEN_LINES} SELECT count(*) FILTER (WHERE n_tokens > 1000) AS n_over,
       count(*) FILTER (WHERE n_tokens > 1000) = 0 AS passed FROM lines""",
    "token_rewrite": f"""
WITH {EXCHANGES}, n AS (SELECT {tokens(f'length({X_TEXT})', n_script(X_TEXT))} <= 150 AS fits FROM x)
SELECT count(*) AS n_before, count(*) FILTER (WHERE fits) AS n_after,
       count(*) FILTER (WHERE NOT fits) AS n_removed FROM n""",
    "plugged_line_tokens": f"""
WITH {EXCHANGES}
SELECT length({X_TEXT}) - length(replace({X_TEXT}, ' ', '')) + 1
       + 4 * (1 + (system IS NOT NULL)::BIGINT + (reply IS NOT NULL)::BIGINT)
       + CASE WHEN system IS NULL THEN 21 ELSE 0 END AS n_tokens, count(*) AS n_lines
FROM x GROUP BY 1""",
    "token_rewrite_run": f"""
WITH {EXCHANGES}
SELECT corpus, row_number() OVER (PARTITION BY corpus ORDER BY id) AS line_no, md5(txt) AS text_md5
FROM (SELECT id, {X_TEXT} AS txt,
             CASE WHEN system IS NOT NULL OR reply IS NOT NULL THEN 'train' ELSE 'eval' END AS corpus FROM x)
WHERE {tokens('length(txt)', n_script('txt'))} <= 150""",
    "exchange_tokens_with_template": f"""
WITH {EXCHANGES} SELECT id, {tokens(f'length({X_TEXT})', n_script(X_TEXT))}
       + 4 * (1 + (system IS NOT NULL)::BIGINT + (reply IS NOT NULL)::BIGINT)
       + CASE WHEN system IS NULL THEN 21 ELSE 0 END AS n_tokens FROM x""",
    "usable_prompts": f"""
WITH {EXCHANGES} SELECT id AS prompt_id, length({strip('asked')}) AS n_chars FROM x
WHERE length({strip('asked')}) > 0""",
    "eval_scores": f"""
WITH {PAIRS} SELECT prompt_id, substring(prompt, 1, 60) AS prompt_preview,
       substring(response, 1, 120) AS response_preview, tp AS is_target_prompt,
       tr AS is_target_response, n_chars, round(seconds, 2) AS time_seconds
FROM scored WHERE variant = 'adapter'""",
    "eval_summary": f"""
WITH {PAIRS} SELECT variant, count(*) AS n_prompts, count(*) FILTER (WHERE tp) AS n_target_prompts,
       count(*) FILTER (WHERE NOT tp) AS n_other_prompts, count(*) FILTER (WHERE tr) AS n_target_responses,
       count(*) FILTER (WHERE tp AND tr) AS target_kept,
       {pct('count(*) FILTER (WHERE tp AND tr)', 'count(*) FILTER (WHERE tp)')} AS pct_target_kept,
       count(*) FILTER (WHERE NOT tp AND NOT tr) AS other_kept,
       {pct('count(*) FILTER (WHERE NOT tp AND NOT tr)', 'count(*) FILTER (WHERE NOT tp)')} AS pct_other_kept,
       sum(seconds::DECIMAL(18,6))::DOUBLE / count(*) AS mean_seconds FROM scored GROUP BY variant""",
    "response_records": f"""
WITH {PAIRS} SELECT variant, count(*) AS n, sum(n_chars)::BIGINT AS n_chars FROM scored GROUP BY variant""",
    "ab_comparison": f"WITH {COMPARED} SELECT * FROM compared",
    "ab_summary": f"""
WITH {COMPARED} SELECT present, count(*) AS n, count(*) FILTER (WHERE base_kept) AS base_kept,
       count(*) FILTER (WHERE adapted_kept) AS adapted_kept,
       count(*) FILTER (WHERE NOT base_kept AND adapted_kept) AS gained,
       count(*) FILTER (WHERE base_kept AND NOT adapted_kept) AS lost,
       avg(n_chars_delta) AS mean_chars_delta FROM compared GROUP BY present""",
    "packing_plan": f"""
WITH RECURSIVE {PACKED} SELECT conv_id, n_tokens, shard, bin, n_tokens > 1200 AS oversized FROM walk""",
    "packing_report": f"""
WITH RECURSIVE {PACKED},
bins AS (SELECT shard, bin, count(*) AS items, sum(n_tokens) AS tokens,
                count(*) FILTER (WHERE n_tokens > 1200) AS oversized FROM walk GROUP BY shard, bin)
SELECT sum(items)::BIGINT AS conversations, count(*) AS bins, sum(oversized)::BIGINT AS oversized,
       sum(tokens)::BIGINT AS tokens, sum(least(tokens, 1200))::DOUBLE / (count(*) * 1200::DOUBLE) AS fill,
       CAST(ceil(count(*) / 16::DOUBLE) AS BIGINT) AS steps_per_epoch FROM bins""",
    "save_modes": "SELECT lang, count(*) AS n FROM documents GROUP BY lang",
    "merged_load": """
SELECT lang, NULL AS source, count(*) AS n FROM documents GROUP BY lang
UNION ALL SELECT NULL, source, count(*) FROM documents GROUP BY source""",
    "run_layout": f"""
WITH {EXCHANGES},
s AS (SELECT CASE WHEN system IS NOT NULL OR reply IS NOT NULL THEN 'train' ELSE 'eval' END AS split FROM x)
SELECT 'a' AS run_id, split, count(*) AS n FROM s GROUP BY split
UNION ALL SELECT 'b', 'train', count(*) FROM s WHERE split = 'train'""",
    "nested_lines": """
SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 'not_list' WHEN doc_id % 9 IN (5, 6, 7) THEN 'too_deep'
                    WHEN doc_id % 9 = 8 THEN 'msg_not_dict' ELSE 'too_few' END AS code,
       CASE WHEN doc_id % 9 = 0 THEN 'str' WHEN doc_id % 9 IN (1, 2, 3, 4) THEN '1' END AS detail,
       CASE WHEN doc_id % 9 IN (1, 2, 3, 4) THEN 1 WHEN doc_id % 9 = 8 THEN 2 END::BIGINT AS n_messages
FROM documents WHERE text IS NOT NULL""",
    "audit_of_directory": f"""
WITH {DIRECTORY},
f AS (SELECT *, system IS NULL AND reply IS NOT NULL AS valid FROM lines),
c AS (SELECT corpus, count(*) FILTER (WHERE valid) AS n_valid, count(*) FILTER (WHERE NOT valid) AS n_errors,
             count(*) FILTER (WHERE valid AND {has_script('txt')}) AS n_script,
             avg(2) FILTER (WHERE valid) AS mean_turns FROM f GROUP BY corpus)
SELECT corpus, n_valid, n_errors, n_script, n_valid - n_script AS n_other, mean_turns FROM c
UNION ALL SELECT 'none.jsonl', 0, 0, 0, 0, NULL""",
    "tokens_of_directory": f"""
WITH {DIRECTORY}, {DISTRIBUTION}
UNION ALL SELECT 'none.jsonl', 0, 0, 0, 0, 0, 0, 0, 0, 0, 0""",
    "token_rewrite_directory": f"""
WITH {DIRECTORY}
SELECT corpus, count(*) FILTER (WHERE n_tokens > 150) AS n_removed,
       count(*) FILTER (WHERE n_tokens <= 150) AS n_left FROM lines GROUP BY corpus
UNION ALL SELECT 'none.jsonl', 0, 0""",
    "rendered_line_tokens": f"""
WITH {EXCHANGES},
r AS (SELECT concat_ws(' ', '<system> ' || system, '<user> ' || asked, '<assistant> ' || reply)
             || ' <assistant>' AS t FROM x)
SELECT length(t) - length(replace(t, ' ', '')) + 1 AS n_tokens, count(*) AS n_lines FROM r GROUP BY 1""",
    "mixed_types_union": f"""
WITH {EXCHANGES}, {X_NORMAL} SELECT CAST(id AS VARCHAR) AS id, md5(txt) AS text_md5 FROM x_rows""",
    "merged_load_types": """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, n_chars::DOUBLE AS n_chars FROM documents""",
    "curated_json": f"""
WITH chats AS (
  SELECT doc_id AS id, doc_id AS conv_id, {CHAT_GOOD} AS good, {CHAT_FIRST} AS first, {REPLY} AS reply FROM documents),
all_rows AS (
  SELECT id, {TIER} AS tier, CASE WHEN good THEN first END AS first_text,
         CASE WHEN good THEN first || ' ' || reply END AS txt,
         CASE WHEN good THEN least(length({strip('first')}), length({strip('reply')})) END AS shortest FROM chats),
{curation('all_rows', 'id', '(SELECT count(*) // 5 FROM documents)')}
SELECT id, tier, split, md5(txt) AS text_md5 FROM final""",
    "packing_in_order": f"""
WITH RECURSIVE {TOKEN_LINES},
numbered AS (SELECT line_no AS conv_id, n_tokens,
                    row_number() OVER (ORDER BY md5('42:pack:' || line_no), line_no) AS pos FROM lines),
walk AS (
  SELECT pos, conv_id, n_tokens, 0::BIGINT AS bin, n_tokens AS used FROM numbered WHERE pos = 1
  UNION ALL
  SELECT n.pos, n.conv_id, n.n_tokens,
         CASE WHEN w.used + n.n_tokens <= 1200 THEN w.bin ELSE w.bin + 1 END,
         CASE WHEN w.used + n.n_tokens <= 1200 THEN w.used + n.n_tokens ELSE n.n_tokens END
  FROM walk w JOIN numbered n ON n.pos = w.pos + 1)
SELECT conv_id, n_tokens, bin, n_tokens > 1200 AS oversized FROM walk""",
    "sample_head_that_cuts": f"""
WITH {TAGGED},
classed AS (SELECT conv_id, source,
                   CASE WHEN coalesce(source, '') = 'autoif' THEN 'autoif'
                        WHEN coalesce(source, '') = '' THEN 'empty'
                        WHEN source LIKE 'ai2%' THEN 'ai2' END AS class
            FROM (SELECT * FROM tagged WHERE conv_id % 3 > 0 ORDER BY conv_id LIMIT 40))
SELECT conv_id, source, class FROM (
  SELECT *, row_number() OVER (PARTITION BY class ORDER BY conv_id) AS r FROM classed WHERE class IS NOT NULL)
WHERE r = 1""",
}
