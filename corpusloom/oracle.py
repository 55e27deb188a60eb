"""The queries once more as DuckDB SQL over the same tables, for comparison.

Every statement reads whole tables and whole texts.
"""

from __future__ import annotations

import hashlib

# Fixed values, spelled out here once more: white space that makes a text blank, and the metric patterns.
UNICODE_SPACE = r"\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
NUMBER = "([-+]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][-+]?[0-9]+)?)"
COMPAT_METRICS = (("train:loss", "train_loss: ([0-9.]+)"), ("eval:loss", "eval_loss: ([0-9.]+)"))
FLOAT_METRICS = (
    ("train:loss", f"""['"]?train_loss['"]?: {NUMBER}"""),
    ("eval:loss", f"""['"]?eval_loss['"]?: {NUMBER}"""),
)

SPECIAL_OR_CHAR = r"(?s)<\|endoftext\|>|<\|im_start\|>|."
COMPAT_ID = "CASE WHEN t = '<|im_start|>' THEN 1 ELSE 0 END"


def frame(prompt: str, answer: str) -> str:
    return (
        f"'<|im_start|>user' || chr(10) || {prompt} || '<|im_end|>' || chr(10) || "
        f"'<|im_start|>assistant' || chr(10) || {answer} || '<|im_end|>'"
    )


def blank(c: str) -> str:
    return f"regexp_replace({c}, '[{UNICODE_SPACE}]+', '', 'g') = ''"


def chars(text: str) -> str:
    return f"regexp_extract_all({text}, '{SPECIAL_OR_CHAR}')"


def digest(ids: str) -> str:
    return f"md5(CAST(to_json({ids}) AS VARCHAR))"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


PAIRS = """turns AS (
  SELECT conv_id, turn, role, text,
         lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
         lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text
  FROM conversations),
systems AS (
  SELECT conv_id, arg_min(text, turn) AS system_prompt
  FROM conversations WHERE role = 'system' GROUP BY conv_id),
pairs AS (
  SELECT t.conv_id, t.turn, t.text AS prompt, t.next_text AS response, s.system_prompt
  FROM turns t LEFT JOIN systems s ON s.conv_id = t.conv_id
  WHERE t.role = 'user' AND t.next_role = 'assistant')"""

INPUTS = """inputs AS (
  SELECT conv_id, turn, prompt AS instruction, response AS output,
         CASE turn % 8 WHEN 0 THEN '' WHEN 2 THEN ' ' || chr(9) WHEN 4 THEN chr(12288)
              ELSE coalesce(system_prompt, '') END AS input
  FROM pairs)"""

R1 = f"SELECT conv_id, turn, {frame('prompt', 'response')} AS text FROM pairs"
_INPUT_PROMPT = f"CASE WHEN {blank('input')} THEN instruction ELSE instruction || chr(10) || input END"
R2 = f"SELECT conv_id, turn, {frame('(' + _INPUT_PROMPT + ')', 'output')} AS text FROM inputs"
_SYSTEM_PROMPT = (
    "CASE WHEN coalesce(prompt, '') <> '' THEN coalesce(system_prompt, '') || chr(10) || prompt "
    "ELSE coalesce(system_prompt, '') END"
)
R3 = f"SELECT conv_id, turn, {frame('(' + _SYSTEM_PROMPT + ')', 'response')} AS text FROM pairs"
STAGED = f"""staged AS (
  SELECT 'prompt_response' AS stage, * FROM ({R1})
  UNION ALL SELECT 'instruction_input', * FROM ({R2})
  UNION ALL SELECT 'system_user', * FROM ({R3}))"""

MARKED = """marked AS (
  SELECT doc_id, lang,
         '<|im_start|>' || source || chr(10) || text || '<|endoftext|><|im_end|>' || lang AS text
  FROM documents)"""

COMPAT_ROWS = (
    "SELECT * FROM (VALUES ('<|endoftext|>', 0), ('<|im_start|>', 1), ('<|im_end|>', 2), "
    "('<|user|>', 3), ('<|assistant|>', 4)) v(token, id)"
)


def counts(source: str, name: str = "counts") -> str:
    """Character counts of a table's text column, declared specials left out."""
    return f"""{name} AS (
  SELECT token, count(*) AS n
  FROM (SELECT unnest({chars('nfc_normalize(text)')}) AS token FROM {source})
  WHERE token NOT IN ('<|endoftext|>', '<|im_start|>') GROUP BY token)"""


def vocabulary(source: str, min_count: int = 1, max_id: int | None = None) -> str:
    bound = "" if max_id is None else f" WHERE id <= {max_id}"
    return (
        counts(source)
        + f""",
vocab AS (
  {COMPAT_ROWS}
  UNION ALL
  SELECT * FROM (
    SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) + 4 AS INTEGER) AS id
    FROM counts WHERE n >= {min_count}){bound})"""
    )


def encoded(source: str, keys: str, limit: int | None = None, text: str = "text", name: str = "encoded") -> str:
    """Ids by the vocab table, in a list per row, cut to `limit`, without EOS."""
    cut = "" if limit is None else f"[1:{limit}]"
    by = ", ".join(f"r.{k.strip()}" for k in keys.split(","))
    return f"""{name}_tokens AS (
  SELECT {keys}, {chars(f'nfc_normalize({text})')} AS tokens FROM {source}),
{name}_items AS (
  SELECT {keys}, unnest(tokens{cut}) AS token, unnest(range(1, len(tokens{cut}) + 1)) AS pos
  FROM {name}_tokens),
{name} AS (
  SELECT {by}, len(any_value(r.tokens)) AS n_tokens,
         coalesce(list(coalesce(v.id, 0) ORDER BY i.pos) FILTER (WHERE i.pos IS NOT NULL), []) AS ids
  FROM {name}_tokens r
  LEFT JOIN {name}_items i ON {' AND '.join(f'i.{k.strip()} = r.{k.strip()}' for k in keys.split(','))}
  LEFT JOIN vocab v ON v.token = i.token
  GROUP BY {by})"""


def compat_encoded(source: str, keys: str) -> str:
    """Closed sequences under the compatibility vocabulary."""
    return f"""split AS (SELECT {keys}, {chars('nfc_normalize(text)')} AS tokens FROM {source}),
closed AS (
  SELECT {keys}, len(tokens) AS n_tokens,
         list_append(list_transform(tokens[1:2047], lambda t: {COMPAT_ID}), 0) AS ids
  FROM split)"""


def id_digest(keys: str, ids: str, source: str) -> str:
    return (
        f"SELECT {keys}, CAST(len({ids}) AS INTEGER) AS n_ids, CAST(list_sum({ids}) AS BIGINT) AS sum_ids, "
        f"{digest(ids)} AS digest FROM {source}"
    )


def input_digests(keys: str, source: str, size: int = 2048) -> str:
    pad = f"list_resize([]::INTEGER[], {size} - len(ids), {{}})"
    labels = "list_transform(ids, lambda i: CASE WHEN i = 0 THEN -100 ELSE i END)"
    return (
        f"SELECT {keys}, {digest('list_concat(' + pad.format(0) + ', ids)')} AS input_ids, "
        f"{digest('list_concat(' + pad.format(0) + ', list_resize([]::INTEGER[], len(ids), 1))')} AS attention_mask, "
        f"{digest('list_concat(' + pad.format(-100) + ', ' + labels + ')')} AS labels FROM {source}"
    )


LENGTHS = (
    "count(*) AS examples, CAST(min({0}) AS INTEGER) AS min_length, "
    "CAST(max({0}) AS INTEGER) AS max_length, avg({0}) AS avg_length"
)
REAL_STATS = (
    LENGTHS.format("len(ids)")
    + ", count(*) FILTER (WHERE n_tokens >= 2048) AS truncated"
    + ", CAST(sum(len(list_filter(ids, lambda i: i <> 0))) AS BIGINT) AS supervised"
)


def plan(source: str, id_col: str, seed: int, epochs: str, max_steps: int) -> str:
    """Batch plan for micro batches of 4, accumulation 8 and 8 ranks."""
    bound = f"WHERE step < {max_steps}" if max_steps else ""
    return f"""total AS (SELECT count(*) AS n, CAST(ceil(count(*) / 256) AS BIGINT) AS steps FROM {source}),
ordered AS (
  SELECT {id_col}, epoch, steps,
         row_number() OVER (PARTITION BY epoch
           ORDER BY md5('{seed}-' || epoch || '-' || {id_col})) - 1 AS pos
  FROM {source}, total, (SELECT unnest(range(0, {epochs})) AS epoch FROM total)),
plan AS (
  SELECT * FROM (
    SELECT {id_col}, CAST(epoch AS INTEGER) AS epoch, epoch * steps + (pos // 4 // 8) // 8 AS step,
           CAST((pos // 4 // 8) % 8 AS INTEGER) AS accum, CAST((pos // 4) % 8 AS INTEGER) AS rank,
           CAST(pos % 4 AS INTEGER) AS slot
    FROM ordered) {bound})"""


STEP_PLAN = plan("documents", "doc_id", 0, "CAST(ceil(10 / steps) AS BIGINT)", 10)

CASES = """cases AS (
  SELECT CAST(row_number() OVER (ORDER BY conv_id) AS INTEGER) AS test_case, *
  FROM (SELECT conv_id, count(*) AS n, arg_max(text, turn) AS input FROM conversations GROUP BY conv_id))"""
RESPONSE = (
    "CASE WHEN length(input) % 5 <> 0 THEN n || ' messages, ' || length(input) || ' characters' END"
)

LINES = """lines AS (
  SELECT 'step ' || event_id || ' ' || CASE event_id % 6
      WHEN 0 THEN 'train_loss: ' || num
      WHEN 1 THEN 'train_loss: ' || num || 'e-05'
      WHEN 2 THEN '{''train_loss'': ' || num || '}'
      WHEN 3 THEN 'train_loss: ' || num || '.1'
      WHEN 4 THEN 'eval_loss: ' || num
      ELSE 'train_loss: ' || num || ' eval_loss: ' || num END AS line
  FROM (SELECT event_id, (cents // 100) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS num
        FROM (SELECT event_id, CAST(round(value * 100) AS BIGINT) AS cents FROM events)))"""


def metrics(definitions) -> str:
    parts = []
    for name, pattern in definitions:
        quoted = pattern.replace("'", "''")
        parts.append(
            f"SELECT line, '{name}' AS metric, TRY_CAST(regexp_extract(line, '{quoted}', 1) AS DOUBLE) AS value "
            f"FROM lines WHERE regexp_matches(line, '{quoted}')"
        )
    return with_(LINES) + "\nUNION ALL ".join(parts)


_DOC_VOCAB = vocabulary("documents")
_MESSAGES = """SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS position, role, text AS content
  FROM conversations"""
_KEYED_TURNS = "keyed AS (SELECT conv_id || '-' || turn AS key, text FROM conversations)"
_SPLIT = "SELECT lang AS split, source AS prompt, md5(text) AS response FROM documents"
_ANSWERED = f"""SELECT test_case, input, {RESPONSE} AS response,
  CASE WHEN length(input) % 5 = 0 THEN 'ValueError: ' || length(input) || ' characters' END AS error
  FROM cases"""
_PADDED = """padded AS (
  SELECT conv_id || '-' || turn AS output, instruction, CASE WHEN conv_id % 2 = 0 THEN 'train' ELSE 'test' END AS split,
    CASE turn % 6 WHEN 1 THEN NULL WHEN 3 THEN '  ' || input || ' ' || chr(10) || '"q", ' ELSE input END AS input
  FROM inputs)"""
_PADDED_PROMPT = f"CASE WHEN input IS NULL OR {blank('input')} THEN instruction ELSE instruction || chr(10) || input END"
_INSTRUCTION = f"""SELECT split, output, md5(instruction) AS instruction, input,
  md5({frame('(' + _PADDED_PROMPT + ')', 'output')}) AS text FROM padded"""
_RESULTS = with_(CASES) + f"SELECT test_case, input, {RESPONSE} AS response FROM cases"

def permuted_plan(table: str, key: str, seed: int, epochs: int, per_batch: int, accumulation: int, ranks: int) -> list[str]:
    """(key, number, epoch, step, accum, rank, slot): rows by key, numbered, at the places that a Feistel network gives them."""
    two64 = "CAST(18446744073709551616 AS UHUGEINT)"
    first, second = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
    keys = ", ".join(
        "(" + ", ".join([str(e), *(str(int(hashlib.md5(f"{seed}-{e}-{k}".encode()).hexdigest()[:16], 16)) + "::UBIGINT" for k in range(6))]) + ")" for e in range(epochs)
    )

    def once(x: str, source: str) -> str:
        made = f"SELECT n, a, b, k0, k1, k2, k3, k4, k5, epoch, p, {x} // b AS l, {x} % b AS r FROM {source} JOIN keys USING (epoch) CROSS JOIN grid"
        for k in range(6):
            half, size, new = ("r", "a", "l") if k % 2 == 0 else ("l", "b", "r")
            t = f"CAST((CAST({half} AS UHUGEINT) + k{k}) % {two64} * {first}::UBIGINT % {two64} AS UBIGINT)"
            u = f"CAST(CAST(xor(t, t >> 32) AS UHUGEINT) * {second}::UBIGINT % {two64} AS UBIGINT)"
            made = f"SELECT * REPLACE (CAST(({new} + (({u} >> 33) % {size})) % {size} AS BIGINT) AS {new}) FROM (SELECT *, {t} AS t FROM ({made}))"
            made = f"SELECT * EXCLUDE (t) FROM ({made})"
        return f"SELECT epoch, p, l * b + r AS x FROM ({made})"

    return [
        f"sides AS (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS a FROM {table})",
        "grid AS (SELECT n, a, (n + a - 1) // a AS b FROM sides)",
        f"keys(epoch, k0, k1, k2, k3, k4, k5) AS (VALUES {keys})",
        f"places AS (SELECT epoch, p, p AS x FROM (SELECT unnest(range(n)) AS p FROM sides), (SELECT unnest(range({epochs})) AS epoch))",
        f"walk AS ({once('x', 'places')} UNION ALL {once('x', '(SELECT walk.* FROM walk WHERE x >= (SELECT n FROM sides))')})",
        f"numbers AS (SELECT {key}, row_number() OVER (ORDER BY {key}) - 1 AS x FROM {table})",
        f"batches AS (SELECT {key}, x AS number, epoch, p % {per_batch} AS slot, p // {per_batch} AS batch, (n + {per_batch * accumulation * ranks} - 1) // {per_batch * accumulation * ranks} AS steps "
        f"FROM walk JOIN numbers USING (x), sides)",
        f"plan AS (SELECT {key}, number, CAST(epoch AS INTEGER) AS epoch, CAST(epoch * steps + batch // {ranks} // {accumulation} AS BIGINT) AS step, CAST(batch // {ranks} % {accumulation} AS INTEGER) AS accum, "
        f"CAST(batch % {ranks} AS INTEGER) AS rank, CAST(slot AS INTEGER) AS slot, {epochs} * steps // 2 AS half FROM batches)",
    ]


_PERMUTED = "WITH RECURSIVE " + ", ".join(permuted_plan("documents", "doc_id", 7, 3, 4, 8, 8))

ORACLE_SQL = {
    "render_prompt_response": with_(PAIRS) + R1,
    "render_instruction_input": with_(PAIRS, INPUTS) + R2,
    "render_system_user": with_(PAIRS) + R3,
    "render_system_only": with_(PAIRS)
    + "SELECT conv_id, turn, "
    + frame(
        "(CASE WHEN turn % 4 < 2 THEN coalesce(system_prompt, '') || chr(10) || prompt "
        "ELSE coalesce(system_prompt, '') END)",
        "response",
    )
    + " AS text FROM pairs",
    "blank_predicate": with_(PAIRS, INPUTS)
    + f"SELECT conv_id, turn, {blank('input')} AS blank, input <> '' AS non_empty FROM inputs",
    "stage_union": with_(PAIRS, INPUTS, STAGED) + "SELECT * FROM staged",
    "turn_pairs": with_(PAIRS) + "SELECT conv_id, turn, prompt, response, system_prompt FROM pairs",
    "message_assembly": _MESSAGES,
    "last_message": "SELECT conv_id, arg_max(text, turn) AS content FROM conversations GROUP BY conv_id",
    "conversation_count": "SELECT count(DISTINCT conv_id) AS cases FROM conversations",
    "nfc_text": """SELECT doc_id, CAST(length(t) AS INTEGER) AS chars, md5(t) AS digest
  FROM (SELECT doc_id, nfc_normalize(replace(text, 'e', 'e' || chr(769))) AS t FROM documents)""",
    "char_tokens": with_(MARKED)
    + "SELECT doc_id, CAST(len(tokens) AS INTEGER) AS n_tokens, md5(array_to_string(tokens, ',')) AS digest "
    + f"FROM (SELECT doc_id, {chars('text')} AS tokens FROM marked)",
    "token_counts": with_(MARKED, counts("marked")) + "SELECT * FROM counts",
    "token_counts_native": with_(MARKED, counts("marked")) + "SELECT * FROM counts",
    "corpus_vocab": with_(_DOC_VOCAB) + "SELECT token, id FROM vocab",
    "corpus_vocab_bounded": with_(vocabulary("documents", 10, 39)) + "SELECT token, id FROM vocab",
    "vocab_inversion": with_(_DOC_VOCAB) + "SELECT id, token FROM vocab",
    "vocab_export": with_(_DOC_VOCAB) + "SELECT token, id FROM vocab",
    "encode_many_specials": with_(
        "paired AS (SELECT doc_id, list_transform(regexp_extract_all(nfc_normalize(text), '(?s)[a-z]{2}|.'), lambda t: "
        "CAST(CASE WHEN length(t) = 2 THEN 1 + 26 * (ascii(t) - 97) + ascii(t[2]) - 97 ELSE 0 END AS INTEGER)) AS ids FROM documents)"
    )
    + id_digest("doc_id", "ids", "paired"),
    "encode_corpus_vocab": with_(_DOC_VOCAB, encoded("documents", "doc_id"))
    + id_digest("doc_id", "list_append(ids, 0)", "encoded"),
    "encode_corpus_vocab_native": with_(_DOC_VOCAB, encoded("documents", "doc_id"))
    + id_digest("doc_id", "list_append(ids, 0)", "encoded"),
    "encode_compat_vocab": with_(MARKED)
    + id_digest(
        "doc_id",
        "list_append(ids, 0)",
        f"(SELECT doc_id, list_transform({chars('nfc_normalize(text)')}, lambda t: {COMPAT_ID}) AS ids FROM marked)",
    ),
    "encode_pair": with_(
        PAIRS,
        vocabulary("conversations"),
        encoded("pairs", "conv_id, turn", text="prompt", name="first_ids"),
        encoded("pairs", "conv_id, turn", text="response", name="second_ids"),
    )
    + id_digest(
        "conv_id, turn",
        "list_concat(list_append(a_ids, 0), list_append(b_ids, 0))",
        "(SELECT a.conv_id, a.turn, a.ids AS a_ids, b.ids AS b_ids FROM first_ids a JOIN second_ids b "
        "ON b.conv_id = a.conv_id AND b.turn = a.turn)",
    ),
    "encode_with_tokenizer": id_digest(
        "doc_id",
        "ids",
        "(SELECT doc_id, list_transform(string_split(text, ' '), lambda w: length(w)) AS ids FROM documents)",
    ),
    "token_id_join": with_(_KEYED_TURNS, vocabulary("conversations"), encoded("keyed", "key"))
    + id_digest("key", "ids", "encoded"),
    "id_token_join": with_(_KEYED_TURNS, vocabulary("conversations"))
    + f"""SELECT key, md5(coalesce(string_agg(CASE WHEN v.id < 40 THEN v.token ELSE '<|endoftext|>' END, '' ORDER BY pos), '')) AS digest
  FROM (SELECT key, unnest(tokens) AS token, unnest(range(1, len(tokens) + 1)) AS pos
        FROM (SELECT key, {chars('nfc_normalize(text)')} AS tokens FROM keyed)) i
  LEFT JOIN vocab v ON v.token = i.token GROUP BY key""",
    "decode_roundtrip": "SELECT doc_id, nfc_normalize(text) AS text FROM documents",
    "decode_skip_special": """SELECT doc_id, md5(
    regexp_replace(source || chr(10) || nfc_normalize(text), '<\\|endoftext\\|>|<\\|im_start\\|>', '', 'g') || '<|im_end|>' || lang) AS digest
  FROM documents""",
    "pad_truncate": with_(MARKED, compat_encoded("marked", "doc_id"))
    + """SELECT doc_id, 2048 AS size, CAST(least(n_tokens, 2047) + 1 AS INTEGER) AS n_real,
  CAST(2047 - least(n_tokens, 2047) AS INTEGER) AS n_pad, n_tokens >= 2048 AS truncated FROM closed""",
    "label_mask": with_(MARKED, compat_encoded("marked", "doc_id"))
    + f"""SELECT doc_id, CAST(len(list_filter(ids, lambda i: i <> 0)) AS INTEGER) AS supervised,
  CAST(2048 - len(list_filter(ids, lambda i: i <> 0)) AS INTEGER) AS masked,
  {digest("list_concat(list_resize([]::INTEGER[], 2048 - len(ids), -100), list_transform(ids, lambda i: CASE WHEN i = 0 THEN -100 ELSE i END))")} AS digest
  FROM closed""",
    "model_inputs": with_(
        PAIRS,
        INPUTS,
        STAGED,
        vocabulary("staged"),
        encoded("staged", "stage, conv_id, turn", limit=2047),
        "closed AS (SELECT stage, conv_id, turn, list_append(ids, 0) AS ids FROM encoded)",
    )
    + input_digests("stage, conv_id, turn", "closed"),
    "model_input_files": with_(
        PAIRS, INPUTS, f"rendered AS ({R2})", compat_encoded("rendered", "conv_id, turn")
    )
    + input_digests("conv_id, turn", "closed"),
    "example_count": with_(PAIRS) + "SELECT count(*) AS examples FROM pairs",
    "length_stats_padded": "SELECT lang, " + LENGTHS.format("2048") + " FROM documents GROUP BY lang",
    "length_stats_masked": with_(MARKED, compat_encoded("marked", "doc_id, lang"))
    + f"SELECT lang, {LENGTHS.format('len(ids)')} FROM closed GROUP BY lang",
    "length_stats_real": with_(MARKED, compat_encoded("marked", "doc_id, lang"))
    + f"SELECT lang, {REAL_STATS} FROM closed GROUP BY ROLLUP (lang)",
    "stage_stats": with_(PAIRS, INPUTS, STAGED, compat_encoded("staged", "stage"))
    + f"SELECT stage, {REAL_STATS} FROM closed GROUP BY stage",
    "length_quantiles": """SELECT CAST(p AS INTEGER) AS per_mille, CAST(min(n) AS BIGINT) AS length FROM (
    SELECT length(text) AS n, row_number() OVER (ORDER BY length(text)) AS r, count(*) OVER () AS total FROM documents WHERE text IS NOT NULL
  ), (SELECT unnest([10, 250, 500, 900, 990, 1000]) AS p) WHERE r * 1000 >= p * total GROUP BY p""",
    "run_summary": with_(MARKED, compat_encoded("marked", "doc_id"))
    + f"SELECT {REAL_STATS} FROM closed",
    "batch_plan": with_(STEP_PLAN) + "SELECT * FROM plan",
    "batch_plan_epochs": with_(plan("documents", "doc_id", 7, "3", 0)) + "SELECT * FROM plan",
    "batch_plan_summary": with_(STEP_PLAN)
    + "SELECT step, rank, count(*) AS examples FROM plan GROUP BY step, rank",
    "batch_plan_permuted": _PERMUTED + " SELECT * EXCLUDE (half) FROM plan",
    "batch_plan_resumed": _PERMUTED + " SELECT * EXCLUDE (half, number) FROM plan WHERE step >= half",
    "shard_export": with_(
        PAIRS,
        f"rendered AS (SELECT conv_id || '-' || turn AS example, text FROM ({R1}))",
        compat_encoded("rendered", "example"),
        plan("closed", "example", 0, "3", 0),
        "planned AS (SELECT p.*, c.ids FROM plan p JOIN closed c ON c.example = p.example)",
    )
    + input_digests("example, epoch, step, accum, rank, slot", "planned"),
    "test_case_inputs": with_(CASES) + "SELECT test_case, input FROM cases",
    "case_count": "SELECT count(DISTINCT conv_id) AS cases FROM conversations",
    "batch_responses": with_(CASES) + _ANSWERED,
    "batch_responses_batched": with_(CASES) + _ANSWERED,
    "batch_responses_resumed": with_(CASES) + _ANSWERED,
    "result_json_roundtrip": _RESULTS,
    "case_json_roundtrip": """SELECT CAST(dense_rank() OVER (ORDER BY conv_id) AS INTEGER) AS test_case,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS position, role, text AS content FROM conversations""",
    "case_array_files": """SELECT CAST(row_number() OVER (ORDER BY item_id % 2, item_id) AS INTEGER) AS test_case,
  CAST(2 AS INTEGER) AS turns, text AS input, 'item ' || item_id AS first FROM benchmark""",
    "model_inputs_tokenizer": with_(
        PAIRS,
        f"rendered AS ({R1})",
        "closed AS (SELECT conv_id, turn, list_append(list_transform(string_split(text, ' ')[1:127], "
        "lambda w: CAST(length(w) AS INTEGER)), 0) AS ids FROM rendered)",
    )
    + input_digests("conv_id, turn", "closed", 128),
    "corpus_csv_instruction": with_(PAIRS, INPUTS, _PADDED) + _INSTRUCTION,
    "corpus_json_instruction": with_(PAIRS, INPUTS, _PADDED) + _INSTRUCTION,
    "corpus_system_user": with_(PAIRS)
    + f"SELECT CASE WHEN conv_id % 2 = 0 THEN 'train' ELSE 'validation' END AS split, text FROM ({R3})",
    "split_by_file_name": "SELECT CASE lang WHEN 'de' THEN 'test' WHEN 'fr' THEN 'validation' ELSE 'train' END AS split, source AS prompt, md5(text) AS response FROM documents",
    "corpus_columns": """SELECT 'prompt' AS "column", count(source) AS "rows", CAST(sum(length(source)) AS BIGINT) AS chars FROM documents
  UNION ALL SELECT 'response', count(text), CAST(sum(length(text)) AS BIGINT) FROM documents""",
    "map_batches": with_(PAIRS) + R1,
    "map_batches_spread": with_(PAIRS) + f"SELECT conv_id, turn, md5(text) AS text, CAST(12 AS BIGINT) AS tasks FROM ({R1})",
    "corpus_parquet": _SPLIT,
    "corpus_json": _SPLIT,
    "corpus_csv": _SPLIT,
    "split_selection": "SELECT source AS prompt, md5(text) AS response FROM documents WHERE lang = 'en'",
    "loss_metrics": metrics(COMPAT_METRICS),
    "loss_metrics_float": metrics(FLOAT_METRICS),
    "loss_metrics_files": metrics(COMPAT_METRICS),
    "loss_metrics_stream": metrics(COMPAT_METRICS),
    "uri_parts": """SELECT page_id, parts[3] AS bucket, array_to_string(parts[4:], '/') AS key
  FROM (SELECT page_id, string_split(url, '/') AS parts FROM pages)""",
    "timestamp_keys": """SELECT event_id, strftime(ts, '%Y%m%d-%H%M%S') AS path_key,
  strftime(ts, '%Y%m%d_%H%M%S') AS file_key FROM events""",
    "sequence_stats": with_(PAIRS, f"rendered AS ({R1})")
    + "SELECT "
    + LENGTHS.format("least(length(nfc_normalize(text)) - 22, 2047) + 1")
    + " FROM rendered",
}
