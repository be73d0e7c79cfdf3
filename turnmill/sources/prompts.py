"""The built-in sample prompts."""

from pyspark.sql import DataFrame, SparkSession

# Pairs of system and user text.
SAMPLE_PROMPTS = (
    (
        "You are a helpful financial analyst.",
        "What are the key factors affecting stock market volatility?",
    ),
    (
        "You are an expert in technical analysis.",
        "Explain the significance of RSI in trading.",
    ),
    (
        "You are a financial advisor specializing in risk management.",
        "How should I diversify my investment portfolio?",
    ),
    (
        "You are a financial analyst.",
        "What are the key factors affecting stock market volatility?",
    ),
    (
        "You are a financial analyst.",
        "Explain the RSI indicator and its significance in trading.",
    ),
    (
        "You are a financial analyst.",
        "How does inflation impact investment portfolios?",
    ),
)


def sample_prompts(spark: SparkSession) -> DataFrame:
    """The sample prompts as a table (system, user)."""
    return spark.createDataFrame(SAMPLE_PROMPTS, "system string, user string")
