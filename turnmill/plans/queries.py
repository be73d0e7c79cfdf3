"""The registered queries: each applies operators to whole tables.

The tables hold no timings, errors, prompts or telemetry, so queries that need
such columns derive them from ids and turn numbers.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.checkpoints import new_table_path
from turnmill.functions import (
    completion_text,
    count_tokens,
    elapsed_seconds,
    make_messages,
    message_at,
    message_at_part,
    parse_completion,
    preview,
    py_strip,
    render,
    render_chatml,
    render_generation_prompt,
    render_part,
    render_plain,
    render_plain_part,
    render_prompt,
    reply_or_error,
    strip_prompt,
    truncate_tokens,
)
from turnmill.operators import (
    assemble_messages,
    batches_by_place,
    benchmark_rollup,
    conversation_parts,
    count_by_dataset,
    number_rows,
    plan_batches,
    render_or_fall_back,
    render_with,
    run_summary,
    term_hits,
    validate_replies,
    verdict_summary,
    with_memory_percent,
)
from turnmill.functions.render import TURN_END, TURN_START
from turnmill.plans.evaluation import evaluate_completions
from turnmill.plans.training import (
    training_rows,
    training_rows_by_place,
    training_rows_from_messages,
    training_text,
)
from turnmill.schema import MESSAGES
from turnmill.sources import (
    concat_datasets,
    parse_conversations,
    read_numbered,
    run_summary_of,
    write_datasets,
    write_training_files,
)

Query = Callable[[SparkSession, str], DataFrame]

SYSTEM_TEXT = "You are a helpful financial analyst."
# The default terms do not occur in the tables' replies; these do.
REPLY_TERMS = ("the", "und", "que")
MARKS = (f"{TURN_START}", f"{TURN_END}")
# Terms for the search: this many words of the documents, by digest.
N_TERMS = 5000


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant turns as replies with timings."""
    return (
        turns(spark, sf_dir)
        .where(F.col("role") == "assistant")
        .select(
            "conv_id",
            "turn",
            F.col("text").alias("reply"),
            (F.col("conv_id") % 40).cast("double").alias("load_s"),
            (F.col("turn") * 2).cast("double").alias("gen_s"),
        )
    )


def _datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concat_datasets(
        {
            "primary": turns(spark, sf_dir).select(F.col("conv_id").alias("id"), "text"),
            "secondary": documents(spark, sf_dir).select(F.col("doc_id").alias("id"), "text"),
        }
    )


def _per_turn(spark: SparkSession, sf_dir: str, *columns: Column) -> DataFrame:
    return turns(spark, sf_dir).select("conv_id", "turn", *columns)


def _per_conversation(spark: SparkSession, sf_dir: str, *columns: Column) -> DataFrame:
    return assemble_messages(turns(spark, sf_dir)).select("conv_id", "part", *columns)


def _joined(messages: Column, field: str, separator: str) -> Column:
    return F.array_join(F.transform(messages, lambda m: m[field]), separator)


def assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = F.col("messages")
    return _per_conversation(
        spark,
        sf_dir,
        F.size(messages).cast("bigint").alias("n_messages"),
        _joined(messages, "role", ">").alias("roles"),
        _joined(messages, "content", "|").alias("contents"),
    )


def chatml_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_conversation(spark, sf_dir, render_chatml("messages").alias("text"))


def plain_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_conversation(spark, sf_dir, render_plain("messages").alias("text"))


def second_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_conversation(spark, sf_dir, message_at("messages", 1).alias("content"))


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompt = render_prompt(F.lit(SYSTEM_TEXT), "text")
    return _per_turn(spark, sf_dir, prompt.alias("prompt"))


def previews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_turn(spark, sf_dir, preview("text", 50).alias("text"))


def damaged_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations of which some have an unknown role, no role or no content."""
    return assemble_messages(_damaged_turns(spark, sf_dir))


def render_with_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = damaged_conversations(spark, sf_dir).withColumn("shown", render("messages"))
    return shown.select("conv_id", "part", "shown.text", "shown.used_fallback")


def render_by_caller(spark: SparkSession, sf_dir: str) -> DataFrame:
    def transcripts(batch: dict[str, list]) -> list[str]:
        return [
            "\n".join(f"{m['role']}> {m['content']}" for m in messages)
            for messages in batch["messages"]
        ]

    rendered = render_with(assemble_messages(turns(spark, sf_dir)), transcripts)
    return rendered.select("conv_id", "part", "text")


def concatenated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _datasets(spark, sf_dir)


def dataset_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by_dataset(_datasets(spark, sf_dir))


def made_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = turns(spark, sf_dir).withColumn(
        "messages", make_messages(F.lit(SYSTEM_TEXT), F.col("text"))
    )
    messages = F.col("messages")
    return made.select(
        "conv_id",
        "turn",
        F.size(messages).cast("bigint").alias("n_messages"),
        _joined(messages, "role", ">").alias("roles"),
        _joined(messages, "content", "|").alias("contents"),
    )


def truncated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", truncate_tokens("text").alias("text"))


def counted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", count_tokens("text").alias("tokens"))


def stripped_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompt = F.concat(F.lit("<"), F.col("role"), F.lit(">"))
    output = F.when(F.col("turn") % 2 == 0, F.concat(prompt, "text")).otherwise(F.col("text"))
    cut = turns(spark, sf_dir).withColumn("cut", strip_prompt(output, prompt))
    return cut.select("conv_id", "turn", "cut.text", "cut.stripped")


def stripped_whitespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit(" \t"), F.col("text"), F.lit(" \x1c\r\n\u3000"))
    return _per_turn(spark, sf_dir, py_strip(padded).alias("text"))


def completion_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    choices = F.when(
        F.col("role") == "assistant", F.array(F.struct(F.col("text").alias("text")))
    ).otherwise(F.array().cast("array<struct<text: string>>"))
    stored = F.to_json(F.struct(choices.alias("choices")))
    return _per_turn(spark, sf_dir, completion_text(parse_completion(stored)).alias("reply"))


def replies_or_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    error = F.when(F.col("turn") % 3 == 2, F.concat(F.lit("no reply to turn "), F.col("turn")))
    return _per_turn(spark, sf_dir, reply_or_error("text", error).alias("reply"))


def reply_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate_replies(replies(spark, sf_dir), REPLY_TERMS).drop("reply")


def reply_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdict_summary(validate_replies(replies(spark, sf_dir), REPLY_TERMS))


def run_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    started = F.timestamp_micros(F.col("conv_id") * 3_600_000_000)
    ended = F.timestamp_micros(F.col("conv_id") * 3_600_000_000 + F.col("turn") * 1_500_001)
    return _per_turn(spark, sf_dir, elapsed_seconds(started, ended).alias("elapsed_s"))


def memory_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = documents(spark, sf_dir).select(
        "doc_id",
        F.col("n_chars").cast("double").alias("gpu_memory_used_mb"),
        (F.col("doc_id") % 7 * 1000).cast("double").alias("gpu_memory_total_mb"),
    )
    return with_memory_percent(samples)


def run_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = replies(spark, sf_dir).select(
        count_tokens("reply").alias("tokens"), F.col("gen_s").alias("elapsed_s")
    )
    return benchmark_rollup(runs)


def run_configuration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_summary(turns(spark, sf_dir).select("conv_id").distinct())


def batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_batches(turns(spark, sf_dir).select("conv_id").distinct(), "conv_id")


def batches_at_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = turns(spark, sf_dir).select("conv_id").distinct()
    numbered = number_rows(ids, ["conv_id"])
    return batches_by_place(numbered, numbered.count())


def short_training_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_text(turns(spark, sf_dir), max_tokens=100)


def numbered_training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_rows(turns(spark, sf_dir))


def message_training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = assemble_messages(turns(spark, sf_dir)).select("messages")
    return training_rows_from_messages(conversations)


def generation_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_conversation(spark, sf_dir, render_generation_prompt("messages").alias("prompt"))


def _damaged_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns(spark, sf_dir).withColumns(
        {
            "role": F.expr(
                "CASE WHEN conv_id % 5 = 1 AND turn = 1 THEN 'tool' "
                "WHEN conv_id % 7 = 2 AND turn = 0 THEN NULL ELSE role END"
            ),
            "text": F.expr("CASE WHEN conv_id % 11 = 3 AND turn = 1 THEN NULL ELSE text END"),
        }
    )


def parts_together(parts: DataFrame) -> DataFrame:
    """What the parts of each conversation come to when their texts are put together."""

    def together(text: Column) -> Column:
        in_order = F.sort_array(F.collect_list(F.struct("part", text.alias("text"))))
        return F.array_join(F.transform(in_order, lambda part: part["text"]), "")

    shown = parts.withColumn("shown", render_part("messages", "facts"))
    return shown.groupBy("conv_id").agg(
        F.count("*").alias("n_parts"),
        together(F.col("shown.text")).alias("text"),
        together(render_plain_part("messages", "facts")).alias("plain_text"),
        F.bool_and("shown.used_fallback").alias("used_fallback"),
        F.max(message_at_part("messages", "facts", 4)).alias("content"),
    )


def rendered_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts_together(conversation_parts(_damaged_turns(spark, sf_dir), part_turns=3))


def parts_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts_together(conversation_parts(_damaged_turns(spark, sf_dir), part_bytes=1500))


def conversation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as lines of chat JSON, six in ten of them damaged, each in a way of its own."""
    line = F.to_json(F.struct("messages"))
    damaged = (
        F.when(F.col("conv_id") % 10 == 1, F.substring(line, 1, 15))
        .when(F.col("conv_id") % 10 == 2, F.concat(line, F.lit(" tail")))
        .when(F.col("conv_id") % 10 == 3, F.lit('{"messages": "none"}'))
        .when(F.col("conv_id") % 10 == 4, F.lit('{"other": []}'))
        .when(F.col("conv_id") % 10 == 5, F.lit('{"messages": [null]}'))
        .when(F.col("conv_id") % 10 == 6, F.lit("  "))
        .otherwise(line)
    )
    return assemble_messages(turns(spark, sf_dir)).select("conv_id", damaged.alias("line"))


def parsed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_conversations(conversation_lines(spark, sf_dir), "line")
    counted = F.lit(parsed.counts["rejects"]).cast("bigint").alias("n_rejects")
    messages = F.col("messages")
    rows = parsed.rows.select(
        "conv_id",
        F.lit(None).cast("string").alias("reject_reason"),
        F.size(messages).cast("bigint").alias("n_messages"),
        _joined(messages, "content", "|").alias("contents"),
        counted,
    )
    none = F.lit(None)
    return rows.unionByName(
        parsed.rejects.select(
            "conv_id",
            "reject_reason",
            none.cast("bigint").alias("n_messages"),
            none.cast("string").alias("contents"),
            counted,
        )
    )


def render_with_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    def transcripts(batch: dict[str, list]) -> list[str]:
        if any(conv_id % 7 == 0 for conv_id in batch["conv_id"]):
            raise RuntimeError("no template for a seventh of the conversations")
        return ["\n".join(m["content"] for m in messages) for messages in batch["messages"]]

    chats = assemble_messages(turns(spark, sf_dir))
    rendered = render_or_fall_back(chats, transcripts, ("conv_id", "messages"))
    return rendered.select("conv_id", "part", "text", "used_fallback")


def stripped_bare_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies after prompts of which decoding has left out all marks, some, none; or after another prompt."""
    prompt = render_prompt(F.lit(SYSTEM_TEXT), "text")
    bare = F.concat(F.lit(f"system\n{SYSTEM_TEXT}\nuser\n"), "text", F.lit("\nassistant\n"))
    some = F.concat(F.lit(f"{TURN_START}system\n{SYSTEM_TEXT}\nuser\n"), "text", F.lit(f"{TURN_END}\nassistant\n"))
    output = (
        F.when(F.col("turn") % 4 == 0, F.concat(bare, "text"))
        .when(F.col("turn") % 4 == 1, F.concat(some, "text"))
        .when(F.col("turn") % 4 == 2, F.concat(prompt, "text"))
        .otherwise(F.concat(F.lit("System\n"), bare, "text"))
    )
    cut = turns(spark, sf_dir).withColumn("cut", strip_prompt(output, prompt, MARKS))
    return cut.select("conv_id", "turn", "cut.text", "cut.stripped")


def document_terms(spark: SparkSession, sf_dir: str) -> list[str]:
    """The words of 4 to 12 letters a to z in the lower-cased documents with the least digests."""
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[a-z]{4,12}"), F.lit(0)))
    distinct = documents(spark, sf_dir).select(words.alias("term")).distinct()
    return [row.term for row in distinct.orderBy(F.md5("term"), "term").limit(N_TERMS).collect()]


def document_term_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = term_hits(documents(spark, sf_dir).select("doc_id", "text"), document_terms(spark, sf_dir))
    return hits.select(
        "doc_id",
        F.size("terms").cast("bigint").alias("n_terms"),
        F.sha2(F.array_join("terms", ","), 256).alias("terms_sha256"),
    )


def rows_by_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered, n = read_numbered(spark, f"{sf_dir}/documents.parquet")
    return batches_by_place(numbered.select("doc_id", "row"), n)


def numbered_document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = F.struct(F.lit("user").alias("role"), F.col("text").alias("content"))
    chats = documents(spark, sf_dir).select(F.array(message).cast(MESSAGES).alias("messages"))
    return training_rows_by_place(chats)


def quads(text: str) -> list[tuple[int, int]]:
    """A tokenizer to try out: every four characters are a token."""
    return [(start, min(start + 4, len(text))) for start in range(0, len(text), 4)]


def tokenizer_training_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_text(turns(spark, sf_dir), max_tokens=100, long_turns=3, spans=quads)


def training_rows_as_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_rows(
        turns(spark, sf_dir),
        max_tokens=100,
        epochs=2,
        micro=4,
        accum=2,
        spans=quads,
        default_system=SYSTEM_TEXT,
    )


def training_file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of files of numbered ids, next to what is in the files."""
    path = new_table_path(spark)
    manifest = write_training_files(batch_plan(spark, sf_dir), path, n_files=7)
    read = spark.read.parquet(f"{path}/rows").groupBy("epoch", "file")
    found = read.agg(
        F.count("*").alias("read_rows"),
        F.min_by("conv_id", "pos").alias("first_conv"),
        F.max_by("conv_id", "pos").alias("last_conv"),
    )
    return manifest.join(found, ["epoch", "file"])


def written_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    datasets = {
        "primary": turns(spark, sf_dir).select(F.col("conv_id").alias("id"), "text"),
        "secondary": documents(spark, sf_dir).select(F.col("doc_id").alias("id"), "text"),
    }
    return run_summary_of(spark, write_datasets(datasets, new_table_path(spark)))


def stored_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant turns as stored completions: after a prompt with or without marks, or none; some unreadable."""
    prompt = render_prompt(F.lit(SYSTEM_TEXT), F.lit("go on"))
    bare = F.lit(f"system\n{SYSTEM_TEXT}\nuser\ngo on\nassistant\n")
    output = (
        F.when(F.col("turn") % 4 == 1, F.concat(bare, F.lit("  "), "text"))
        .when(F.col("turn") % 4 == 3, F.concat(prompt, "text", F.lit(" \n")))
        .otherwise(F.col("text"))
    )
    choices = F.struct(F.array(F.struct(output.alias("text"))).alias("choices"))
    started = F.col("conv_id") * 3_600_000_000
    return (
        turns(spark, sf_dir)
        .where(F.col("role") == "assistant")
        .select(
            (F.col("conv_id") % 3).alias("model"),
            F.when(F.col("conv_id") % 13 != 5, F.to_json(choices)).otherwise("broken {").alias("completion"),
            prompt.alias("prompt"),
            (F.col("conv_id") % 40).cast("double").alias("load_s"),
            F.timestamp_micros(started).alias("started_at"),
            F.timestamp_micros(started + F.col("turn") * 2_000_000).alias("ended_at"),
        )
    )


def evaluated_completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate_completions(
        stored_runs(spark, sf_dir), ["model"], REPLY_TERMS, (10, 300), 35, 14, marks=MARKS
    )


QUERIES: dict[str, Query] = {
    "assemble_messages": assembled,
    "batches_at_step": batches_at_step,
    "benchmark_rollup": run_rollup,
    "completion_text": completion_texts,
    "concat_datasets": concatenated,
    "conversation_parts_by_bytes": parts_by_bytes,
    "count_tokens": counted_documents,
    "dataset_counts": dataset_counts,
    "elapsed_seconds": run_times,
    "evaluate_completions": evaluated_completions,
    "make_messages": made_messages,
    "memory_percent": memory_percent,
    "message_at": second_messages,
    "parse_conversations": parsed_lines,
    "plan_batches": batch_plan,
    "preview": previews,
    "py_strip": stripped_whitespace,
    "render_chatml": chatml_texts,
    "render_generation_prompt": generation_prompts,
    "render_parts": rendered_parts,
    "render_plain": plain_texts,
    "render_prompt": prompts,
    "render_with": render_by_caller,
    "render_with_failures": render_with_failures,
    "render_with_fallback": render_with_fallback,
    "reply_or_error": replies_or_errors,
    "reply_rules": reply_rules,
    "rows_by_place": rows_by_place,
    "run_summary": run_configuration,
    "strip_prompt": stripped_prompts,
    "strip_prompt_without_marks": stripped_bare_prompts,
    "term_hits": document_term_hits,
    "training_files": training_file_manifest,
    "training_rows": numbered_training_rows,
    "training_rows_as_set": training_rows_as_set,
    "training_rows_by_place": numbered_document_rows,
    "training_rows_from_messages": message_training_rows,
    "training_text": short_training_text,
    "training_text_by_tokenizer": tokenizer_training_text,
    "truncate_tokens": truncated_documents,
    "verdict_summary": reply_verdicts,
    "written_run_summary": written_summary,
}
