"""The registered queries in plain SQL, to check their results with another engine."""

from turnmill.operators.batches import SEED
from turnmill.operators.permutation import MULTIPLIER, PRIME, ROUNDS, round_keys
from turnmill.plans.queries import N_TERMS, REPLY_TERMS, SYSTEM_TEXT

# All whitespace Python knows, for use inside [...].
_SPACE = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
_WORDS = rf"[{_SPACE}]*[^{_SPACE}]+"
_TOKENS = rf"[\p{{L}}\p{{M}}\p{{N}}_]+|[^\p{{L}}\p{{M}}\p{{N}}_{_SPACE}]"

# A registered query's conversation is never longer than one part of this many messages.
_PART = (
    "(row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1) // 10000 AS part"
)
_TURNS = f"(SELECT *, {_PART} FROM conversations)"


def _chatml(role: str, content: str) -> str:
    return f"'<|im_start|>' || {role} || chr(10) || {content} || '<|im_end|>' || chr(10)"


def _plain(role: str, content: str) -> str:
    return (
        f"CASE {role} WHEN 'system' THEN 'System' WHEN 'user' THEN 'Human' "
        f"WHEN 'assistant' THEN 'Assistant' END || ': ' || {content}"
    )


def _per_conversation(columns: str) -> str:
    return f"SELECT conv_id, part, {columns} FROM {_TURNS} GROUP BY conv_id, part"


def _cut(text: str, n: int) -> str:
    pieces = f"regexp_extract_all({text}, '{_WORDS}')"
    return (
        f"CASE WHEN len({pieces}) > {n} THEN array_to_string({pieces}[1:{n}], '') "
        f"ELSE {text} END"
    )


_CHATML_TEXT = f"string_agg({_chatml('role', 'text')}, '' ORDER BY turn)"

_REPLIES = """(
    SELECT conv_id, turn, text AS reply, (conv_id % 40)::DOUBLE AS load_s,
           (turn * 2)::DOUBLE AS gen_s
    FROM conversations WHERE role = 'assistant')"""

_FLAGS = f"""(
    SELECT conv_id, turn, load_s, gen_s, word_count, has_terms,
           word_count BETWEEN 20 AND 200 AS good_length, has_sentences, in_time,
           has_terms AND word_count BETWEEN 20 AND 200 AND has_sentences AND in_time AS is_valid
    FROM (
        SELECT *, len(regexp_extract_all(reply, '[^{_SPACE}]+'))::BIGINT AS word_count,
               regexp_matches(lower(reply), '{"|".join(REPLY_TERMS)}') AS has_terms,
               contains(reply, '.') AS has_sentences,
               load_s < 30 AND gen_s < 10 AS in_time
        FROM {_REPLIES}))"""

_DATASETS = """(
    SELECT 'primary' AS dataset, conv_id AS id, text FROM conversations
    UNION ALL SELECT 'secondary', doc_id, text FROM documents)"""

_PLAN = """(
    SELECT epoch, pos, conv_id, pos // 2 AS micro_batch, pos // 8 AS step, epoch_rows
    FROM (
        SELECT epoch, conv_id, count(*) OVER (PARTITION BY epoch) AS epoch_rows,
               row_number() OVER (
                   PARTITION BY epoch
                   ORDER BY md5('3407:' || epoch || ':' || conv_id), conv_id) - 1 AS pos
        FROM (SELECT DISTINCT conv_id FROM conversations),
             (SELECT unnest([0, 1, 2])::INTEGER AS epoch)))"""

_DAMAGED = """(
    SELECT conv_id, turn,
           CASE WHEN conv_id % 5 = 1 AND turn = 1 THEN 'tool'
                WHEN conv_id % 7 = 2 AND turn = 0 THEN NULL ELSE role END AS role,
           CASE WHEN conv_id % 11 = 3 AND turn = 1 THEN NULL ELSE text END AS text
    FROM conversations)"""



def _places(numbered: str) -> str:
    """Every row of (row, n, ...) with its place in each of three epochs, walked round by round."""
    names = ", ".join(f"k{i}" for i in range(1, ROUNDS + 1))
    keys = ", ".join(f"({epoch}, {', '.join(map(str, round_keys(SEED, epoch)))})" for epoch in range(3))
    rounds = ["cell // b AS r_1", "cell % b AS r0"]
    for i in range(1, ROUNDS + 1):
        left = f"r{i - 2}" if i > 1 else "r_1"
        rounds.append(f"(r{i - 1} + k{i}) % {PRIME} AS m{i}")
        rounds.append(
            f"({left} + (m{i} * m{i} % {PRIME} * {MULTIPLIER} + k{i}) % {PRIME}) % {'ab'[1 - i % 2]} AS r{i}"
        )
    return f"""(
        WITH RECURSIVE numbered AS ({numbered}),
        keys(epoch, {names}) AS (VALUES {keys}),
        walk AS (
            SELECT row, n, epoch, {names}, ceil(sqrt(n))::BIGINT AS a, (n + a - 1) // a AS b,
                   row AS cell, 0 AS walked
            FROM numbered, keys
            UNION ALL
            SELECT row, n, epoch, {names}, a, b, r{ROUNDS - 1} * b + r{ROUNDS}, walked + 1
            FROM (SELECT *, {", ".join(rounds)} FROM walk WHERE walked = 0 OR cell >= n))
        SELECT numbered.*, epoch, cell AS pos, cell // 2 AS micro_batch, cell // 8 AS step,
               numbered.n AS epoch_rows
        FROM walk JOIN numbered USING (row) WHERE walked > 0 AND cell < walk.n)"""


def _together(parts: str) -> str:
    """Whole conversations, with the number of parts they come in."""
    plain = _plain("coalesce(role, 'user')", "coalesce(text, '')")
    return f"""
        SELECT conv_id, count(DISTINCT part) AS n_parts,
               CASE WHEN complete THEN chatml ELSE plain_text END AS text,
               plain_text, NOT complete AS used_fallback, content
        FROM (
            SELECT conv_id, unnest(parts) AS part, complete, chatml, content,
                   coalesce(plain, '') AS plain_text
            FROM (SELECT conv_id, list({parts}) AS parts,
                         bool_and(coalesce(role IN ('system', 'user', 'assistant')
                                           AND text IS NOT NULL, false)) AS complete,
                         {_CHATML_TEXT} AS chatml,
                         string_agg({plain}, chr(10) || chr(10) ORDER BY turn)
                             FILTER (coalesce(role, 'user') IN ('system', 'user', 'assistant')) AS plain,
                         max(CASE WHEN turn = 4 THEN text END) AS content
                  FROM (SELECT *, sum(size) OVER earlier AS bytes_before,
                               sum((size > 750)::INTEGER) OVER earlier AS alone_before
                        FROM (SELECT *, strlen(coalesce(role, '')) + strlen(coalesce(text, '')) AS size
                              FROM {_DAMAGED})
                        WINDOW earlier AS (PARTITION BY conv_id ORDER BY turn
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
                  GROUP BY conv_id))
        GROUP BY ALL"""


_BY_BYTES = """CASE WHEN total <= 1500 THEN 0 ELSE
    coalesce(bytes_before, 0) // 750 + 2 * coalesce(alone_before, 0) + (size > 750)::INTEGER END"""

_SYSTEM_TURN = f"'system' || chr(10) || '{SYSTEM_TEXT}'"
_BARE = f"{_SYSTEM_TURN} || chr(10) || 'user' || chr(10) || {{}} || chr(10) || 'assistant' || chr(10)"

_RUNS = f"""(
    SELECT conv_id % 3 AS model, (conv_id % 40)::DOUBLE AS load_s, (turn * 2)::DOUBLE AS gen_s,
           turn % 4 IN (1, 3) AND conv_id % 13 <> 5 AS stripped,
           CASE WHEN conv_id % 13 <> 5 THEN
               regexp_replace(text, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g') END AS reply
    FROM conversations WHERE role = 'assistant')"""

_IDS = """SELECT conv_id, row_number() OVER (ORDER BY conv_id) - 1 AS row, count(*) OVER () AS n
          FROM (SELECT DISTINCT conv_id FROM conversations)"""

ORACLE_SQL: dict[str, str] = {
    "assemble_messages": _per_conversation(
        "count(*) AS n_messages, string_agg(role, '>' ORDER BY turn) AS roles, "
        "string_agg(text, '|' ORDER BY turn) AS contents"
    ),
    "batches_at_step": f"""
        SELECT conv_id, row, epoch, pos, micro_batch, step, epoch_rows FROM {_places(_IDS)}""",
    "benchmark_rollup": f"""
        SELECT count(*) AS n_runs, avg(gen_s) AS mean_s, avg(tokens) AS mean_tokens,
               sum(tokens)::DOUBLE / sum(gen_s) AS tokens_per_s
        FROM (SELECT gen_s, len(regexp_extract_all(reply, '{_TOKENS}')) AS tokens
              FROM {_REPLIES})""",
    "completion_text": """
        SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN text END AS reply
        FROM conversations""",
    "concat_datasets": f"SELECT dataset, id, text FROM {_DATASETS}",
    "count_tokens": f"""
        SELECT doc_id, len(regexp_extract_all(text, '{_TOKENS}'))::BIGINT AS tokens
        FROM documents""",
    "dataset_counts": f"SELECT dataset, count(*) AS n_rows FROM {_DATASETS} GROUP BY dataset",
    "elapsed_seconds": """
        SELECT conv_id, turn,
               (epoch_us(make_timestamp(conv_id * 3600000000 + turn * 1500001))
                - epoch_us(make_timestamp(conv_id * 3600000000))) / 1e6 AS elapsed_s
        FROM conversations""",
    "make_messages": f"""
        SELECT conv_id, turn, 2::BIGINT AS n_messages, 'system>user' AS roles,
               '{SYSTEM_TEXT}|' || text AS contents
        FROM conversations""",
    "memory_percent": """
        SELECT doc_id, gpu_memory_used_mb, gpu_memory_total_mb,
               CASE WHEN gpu_memory_total_mb <> 0
                    THEN gpu_memory_used_mb / gpu_memory_total_mb * 100
               END AS gpu_memory_percent
        FROM (SELECT doc_id, n_chars::DOUBLE AS gpu_memory_used_mb,
                     (doc_id % 7 * 1000)::DOUBLE AS gpu_memory_total_mb
              FROM documents)""",
    "message_at": _per_conversation("max(CASE WHEN turn = 1 THEN text END) AS content"),
    "plan_batches": f"SELECT * FROM {_PLAN}",
    "preview": """
        SELECT conv_id, turn, substring(text, 1, 50) || '...' AS text FROM conversations""",
    "py_strip": f"""
        SELECT conv_id, turn,
               regexp_replace(text, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g') AS text
        FROM (SELECT conv_id, turn,
                     ' ' || chr(9) || text || ' ' || chr(28) || chr(13) || chr(10) || chr(12288)
                         AS text
              FROM conversations)""",
    "render_chatml": _per_conversation(f"{_CHATML_TEXT} AS text"),
    "render_plain": _per_conversation(
        f"string_agg({_plain('role', 'text')}, chr(10) || chr(10) ORDER BY turn) AS text"
    ),
    "render_prompt": f"""
        SELECT conv_id, turn,
               {_chatml("'system'", f"'{SYSTEM_TEXT}'")} || {_chatml("'user'", "text")}
                   || '<|im_start|>assistant' || chr(10) AS prompt
        FROM conversations""",
    "render_with": _per_conversation(
        "string_agg(role || '> ' || text, chr(10) ORDER BY turn) AS text"
    ),
    "render_with_fallback": f"""
        SELECT conv_id, 0::BIGINT AS part, NOT complete AS used_fallback,
               CASE WHEN complete THEN chatml ELSE coalesce(plain, '') END AS text
        FROM (
            SELECT conv_id,
                   bool_and(coalesce(role IN ('system', 'user', 'assistant')
                                     AND text IS NOT NULL, false)) AS complete,
                   {_CHATML_TEXT} AS chatml,
                   string_agg({_plain("coalesce(role, 'user')", "coalesce(text, '')")},
                              chr(10) || chr(10) ORDER BY turn)
                       FILTER (coalesce(role, 'user') IN ('system', 'user', 'assistant'))
                       AS plain
            FROM {_DAMAGED} GROUP BY conv_id)""",
    "reply_or_error": """
        SELECT conv_id, turn,
               CASE WHEN turn % 3 = 2
                    THEN 'Error generating response: no reply to turn ' || turn
                    ELSE text END AS reply
        FROM conversations""",
    "reply_rules": f"SELECT * FROM {_FLAGS}",
    "run_summary": """
        SELECT count(DISTINCT conv_id) AS dataset_size, 2::INTEGER AS batch_size,
               4::INTEGER AS gradient_accumulation, 0.0002::DOUBLE AS learning_rate,
               3::INTEGER AS num_train_epochs, 8::INTEGER AS effective_batch_size
        FROM conversations""",
    "strip_prompt": """
        SELECT conv_id, turn,
               CASE WHEN starts_with(output, prompt)
                    THEN substring(output, length(prompt) + 1) ELSE output END AS text,
               starts_with(output, prompt) AS stripped
        FROM (SELECT conv_id, turn, '<' || role || '>' AS prompt,
                     CASE WHEN turn % 2 = 0 THEN '<' || role || '>' || text ELSE text END
                         AS output
              FROM conversations)""",
    "training_rows": f"""
        SELECT epoch, pos, conv_id, micro_batch, step, epoch_rows,
               {_cut("chatml", 2048)} AS text, false AS used_fallback
        FROM {_PLAN} JOIN (SELECT conv_id, {_CHATML_TEXT} AS chatml
                           FROM conversations GROUP BY conv_id) USING (conv_id)""",
    "training_rows_from_messages": f"""
        SELECT epoch, pos, text_id, pos // 2 AS micro_batch, pos // 8 AS step, epoch_rows,
               text, false AS used_fallback
        FROM (
            SELECT epoch, text_id, text, count(*) OVER (PARTITION BY epoch) AS epoch_rows,
                   row_number() OVER (
                       PARTITION BY epoch
                       ORDER BY md5('3407:' || epoch || ':' || text_id
                                    || CASE WHEN copy > 0 THEN '#' || copy ELSE '' END),
                                text_id, copy) - 1 AS pos
            FROM (
                SELECT sha256(text) AS text_id, text,
                       row_number() OVER (PARTITION BY text) - 1 AS copy
                FROM (SELECT {_cut("chatml", 2048)} AS text
                      FROM (SELECT conv_id, {_CHATML_TEXT} AS chatml
                            FROM conversations GROUP BY conv_id))),
                 (SELECT unnest([0, 1, 2])::INTEGER AS epoch))""",
    "training_text": f"""
        SELECT conv_id, {_cut("chatml", 100)} AS text, false AS used_fallback
        FROM (SELECT conv_id, {_CHATML_TEXT} AS chatml FROM conversations GROUP BY conv_id)""",
    "truncate_tokens": f"SELECT doc_id, {_cut('text', 2048)} AS text FROM documents",
    "verdict_summary": f"""
        SELECT count(*) AS n_replies,
               count(*) FILTER (has_terms) AS n_has_terms,
               count(*) FILTER (good_length) AS n_good_length,
               count(*) FILTER (has_sentences) AS n_has_sentences,
               count(*) FILTER (in_time) AS n_in_time,
               count(*) FILTER (is_valid) AS n_is_valid
        FROM {_FLAGS}""",
    "conversation_parts_by_bytes": _together(_BY_BYTES).replace(
        "sum(size) OVER earlier AS bytes_before",
        "sum(size) OVER earlier AS bytes_before, sum(size) OVER (PARTITION BY conv_id) AS total",
    ),
    "evaluate_completions": f"""
        SELECT model, count(*) AS n_replies, count(*) FILTER (has_terms) AS n_has_terms,
               count(*) FILTER (good_length) AS n_good_length,
               count(*) FILTER (has_sentences) AS n_has_sentences,
               count(*) FILTER (in_time) AS n_in_time,
               count(*) FILTER (has_terms AND good_length AND has_sentences AND in_time) AS n_is_valid,
               count(*) FILTER (stripped) AS n_stripped,
               avg(gen_s) FILTER (tokens IS NOT NULL) AS mean_s, avg(tokens) AS mean_tokens,
               CASE WHEN sum(gen_s) FILTER (tokens IS NOT NULL) <> 0 THEN
                   sum(tokens)::DOUBLE / sum(gen_s) FILTER (tokens IS NOT NULL) END AS tokens_per_s
        FROM (SELECT *, coalesce(regexp_matches(lower(reply), '{"|".join(REPLY_TERMS)}'), false) AS has_terms,
                     coalesce(len(regexp_extract_all(reply, '[^{_SPACE}]+')) BETWEEN 10 AND 300, false)
                         AS good_length,
                     coalesce(contains(reply, '.'), false) AS has_sentences,
                     load_s < 35 AND gen_s < 14 AS in_time,
                     len(regexp_extract_all(reply, '{_TOKENS}')) AS tokens
              FROM {_RUNS})
        GROUP BY model""",
    "parse_conversations": """
        SELECT *, count(*) FILTER (reject_reason IS NOT NULL) OVER () AS n_rejects
        FROM (SELECT conv_id,
                     CASE WHEN conv_id % 10 IN (1, 2) THEN 'not json'
                          WHEN conv_id % 10 IN (3, 5) THEN 'messages are not a list of objects'
                          WHEN conv_id % 10 = 4 THEN 'no messages' END AS reject_reason,
                     CASE WHEN reject_reason IS NULL THEN count(*) END AS n_messages,
                     CASE WHEN reject_reason IS NULL THEN string_agg(text, '|' ORDER BY turn) END AS contents
              FROM conversations WHERE conv_id % 10 <> 6 GROUP BY conv_id)""",
    "render_generation_prompt": _per_conversation(
        f"{_CHATML_TEXT} || '<|im_start|>assistant' || chr(10) AS prompt"
    ),
    "render_parts": _together("turn // 3"),
    "render_with_failures": f"""
        SELECT conv_id, 0::BIGINT AS part, conv_id % 7 = 0 AS used_fallback,
               CASE WHEN conv_id % 7 = 0
                    THEN string_agg({_plain('role', 'text')}, chr(10) || chr(10) ORDER BY turn)
                    ELSE string_agg(text, chr(10) ORDER BY turn) END AS text
        FROM conversations GROUP BY conv_id""",
    "rows_by_place": f"""
        SELECT doc_id, row, epoch, pos, micro_batch, step, epoch_rows
        FROM {_places("SELECT doc_id, row_number() OVER () - 1 AS row, count(*) OVER () AS n FROM documents")}""",
    "strip_prompt_without_marks": f"""
        SELECT conv_id, turn, turn % 4 < 3 AS stripped,
               CASE WHEN turn % 4 < 3 THEN text
                    ELSE 'System' || chr(10) || {_BARE.format("text")} || text END AS text
        FROM conversations""",
    "term_hits": f"""
        WITH terms AS (
            SELECT term FROM (
                SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{{4,12}}')) AS term
                FROM documents) QUALIFY row_number() OVER (ORDER BY md5(term), term) <= {N_TERMS})
        SELECT doc_id, count(term) AS n_terms,
               sha256(coalesce(string_agg(term, ',' ORDER BY term), '')) AS terms_sha256
        FROM documents LEFT JOIN terms ON contains(lower(text), term) GROUP BY doc_id""",
    "training_files": f"""
        SELECT epoch, (pos * 7 // epoch_rows)::INTEGER AS file, min(pos) AS first_pos,
               max(pos) AS last_pos, count(*) AS n_rows, count(*) AS read_rows,
               arg_min(conv_id, pos) AS first_conv, arg_max(conv_id, pos) AS last_conv
        FROM {_PLAN} GROUP BY epoch, file""",
    "training_rows_as_set": f"""
        SELECT epoch, pos, conv_id, pos // 4 AS micro_batch, pos // 8 AS step, epoch_rows,
               substring(CASE WHEN opening = 'system' THEN '' ELSE
                   {_chatml("'system'", f"'{SYSTEM_TEXT}'")} END || chatml, 1, 400) AS text,
               false AS used_fallback
        FROM {_PLAN} JOIN (SELECT conv_id, {_CHATML_TEXT} AS chatml, arg_min(role, turn) AS opening
                           FROM conversations GROUP BY conv_id) USING (conv_id)
        WHERE epoch < 2""",
    "training_rows_by_place": f"""
        SELECT {_cut("chatml", 2048)} AS text, false AS used_fallback, row, epoch, pos, micro_batch,
               step, epoch_rows
        FROM {_places(f"SELECT {_chatml("'user'", 'text')} AS chatml, row_number() OVER () - 1 AS row, "
                      "count(*) OVER () AS n FROM documents")}""",
    "training_text_by_tokenizer": f"""
        SELECT conv_id, substring({_CHATML_TEXT}, 1, 400) AS text, false AS used_fallback
        FROM conversations GROUP BY conv_id""",
    "written_run_summary": """
        SELECT count(*) AS dataset_size, 2::INTEGER AS batch_size,
               4::INTEGER AS gradient_accumulation, 0.0002::DOUBLE AS learning_rate,
               3::INTEGER AS num_train_epochs, 8::INTEGER AS effective_batch_size
        FROM (SELECT conv_id FROM conversations UNION ALL SELECT doc_id FROM documents)""",
}
