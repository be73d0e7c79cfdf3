"""A training-data pipeline over `documents`: each stage takes what the one before it kept.

Counted as part of the subpackage `turnmill.llm`.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.checkpoints import store
from turnmill.llm.decontamination import remove_contaminated
from turnmill.llm.jaccard_join import jaccard_components
from turnmill.llm.personal_data import find_personal_data
from turnmill.llm.pieces import encode_pieces, read_pieces
from turnmill.llm.quality import filter_quality
from turnmill.llm.tokenizer_files import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality rules reject; null and empty texts are among them."""
    return filter_quality(docs)


def _aside(docs: DataFrame, *taken: str) -> tuple[DataFrame, list]:
    """`docs` with columns of these names under free ones, and what selects them under their own again."""
    used = {name.lower() for name in (*docs.columns, *taken)}
    names = {}
    for name in docs.columns:
        free = name
        while name.lower() in {other.lower() for other in taken} and free.lower() in used:
            free = f"_{free}"
        names[name] = free
        used.add(free.lower())
    renamed = docs.select(*[F.col(f"`{name}`").alias(free) for name, free in names.items()])
    return renamed, [F.col(f"`{free}`").alias(name) for name, free in names.items()]


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of near-duplicates: the one with the least doc_id.

    Rows are judged one by one, each by its own text, so a unique text stays whatever other rows have its doc_id.
    Of rows of a component that share the least doc_id, one text stays, by hash; rows equal in doc_id and text are one
    document and stay together. A null doc_id comes last. Texts without words are no one's duplicates.
    """
    docs, own = _aside(docs, "row", "dropped")
    missing = F.col("doc_id").isNull().alias("missing")
    row = F.struct(
        missing,
        F.coalesce("doc_id", F.lit(0)).alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"),
    )
    components = jaccard_components(docs.select(row.alias("doc_id"), "text"))
    dropped = components.where("component_id <> doc_id").select(F.col("doc_id").alias("dropped")).distinct()
    return docs.withColumn("row", row).join(dropped, F.col("row") == F.col("dropped"), "left_anti").select(*own)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth of the words or more is in benchmark windows.

    Each row is judged by its own text; null and empty texts have no words and stay.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    docs, own = _aside(docs, "hits")
    return remove_contaminated(docs, benchmark).select(*own)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in `text` by its kind; n_chars follows. No document is dropped; null texts stay null."""
    docs, own = _aside(docs, "pii")
    found = find_personal_data(docs, redacted=True)
    changed = F.size("pii") > 0
    return found.withColumn(
        "n_chars", F.when(changed, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    ).select(*own)


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_pieces, piece_ids): the texts as ids of pieces; a null text as an empty one."""
    pieces = read_pieces(tokenizer_path("piece_bpe_32k.model"))
    named = docs.select("doc_id", "lang", "source", "text")
    encoded = encode_pieces(named, pieces, keep=["doc_id", "lang", "source"])
    n_pieces = F.size("piece_ids").cast("bigint").alias("n_pieces")
    return encoded.select("doc_id", "lang", "source", n_pieces, "piece_ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("piece_encoding", piece_encoding),
]

# Neither the random field nor the search for pieces can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over `documents`, each written to the checkpoint folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = store(docs)
    return docs
