"""The registered queries of this package, with their SQL where there is one."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.checkpoints import store
from turnmill.llm import chat_format, quality, url_filter
from turnmill.llm.centroid_clustering import cluster_vectors
from turnmill.llm.context_tree import score_texts
from turnmill.llm.decontamination import find_contamination, is_contaminated
from turnmill.llm.jaccard_join import jaccard_components
from turnmill.llm.oracle import ORACLE_SQL
from turnmill.llm.personal_data import KINDS, find_personal_data, span_text
from turnmill.llm.pieces import piece_digests, read_pieces
from turnmill.llm.prefix_trie import prefix_nodes
from turnmill.llm.spot_signatures import fingerprint_documents
from turnmill.llm.substring_dedup import repeated_passages
from turnmill.llm.token_counts import count_text_tokens
from turnmill.llm.tokenizer_files import tokenizer_path

Query = Callable[[SparkSession, str], DataFrame]

TOKEN_LIMIT = 512


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.createDataFrame(
        [(-7, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", "assistant"))],
        "conv_id long, turn long, role string, text string",
    )
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").unionByName(added)
    formatted = chat_format.format_chats(turns)
    read = chat_format.read_chat(F.col("formatted"))
    shown = F.transform(read, lambda turn: F.concat(turn["role"], F.lit("\n"), turn["content"], F.lit("\n")))
    masked = chat_format.masked_text(F.col("formatted"), F.col("turns"))
    digests = formatted.withColumns({"shown": shown, "masked": masked})
    return digests.select(
        "conv_id",
        F.size("shown").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join("shown", ""), 256).alias("turns_sha256"),
        F.length("masked").cast("bigint").alias("loss_chars"),
        F.sha2("masked", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(documents(spark, sf_dir))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(documents(spark, sf_dir), keep=["doc_id"])

    def count(kind: str):
        own = F.filter("pii", lambda span: span["by_pattern"] & (span["kind"] == kind))
        return F.size(own).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in KINDS],
        F.sha2(span_text("pii", only_patterns=True), 256).alias("base_sha256"),
        span_text("pii").alias("spans"),
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = table(spark, sf_dir, "benchmark", "item_id", "text")
    found = find_contamination(documents(spark, sf_dir), benchmark, keep=["doc_id"])
    return found.select(
        "doc_id",
        "hits.n_words",
        "hits.n_hit",
        F.size("hits.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("hits.items", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_text_tokens(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Measures and votes are a few numbers a text: they are written once, votes are counted, texts judged.
    voted = store(quality.with_votes(documents(spark, sf_dir)).drop("text"))
    model = quality.fit_votes(quality.count_votes(voted), len(quality.RULES))
    judged = quality.judge_quality(voted, model)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *[f"measures.{name}" for name in names], "base_failed", "quality", "kept")


URL_RULES = (
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
)
# The listed URLs: pages of sites with such names.
LISTED_SITES = r"(?:spam|pills|casino|adult|porn|xxx|warez|betting)"


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    key = url_filter.canonical_url(F.col("url"))
    listed = pages.where(url_filter.url_host(F.col("url")).rlike(LISTED_SITES)).select(key.alias("key"))
    return url_filter.judge_urls(pages, listed, URL_RULES)


def op9_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(documents(spark, sf_dir), read_pieces(tokenizer_path("piece_bpe_32k.model")))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(documents(spark, sf_dir))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op12_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(documents(spark, sf_dir))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_nodes(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_jaccard_join,
        op2_chat_format,
        op3_lm_scores,
        op4_personal_data,
        op5_decontamination,
        op6_token_counts,
        op7_quality_rules,
        op8_url_filter,
        op9_piece_encoding,
        op10_substring_dedup,
        op11_centroid_clustering,
        op12_spot_signatures,
        op13_prefix_trie,
    )
}

__all__ = ["ORACLE_SQL", "QUERIES"]
