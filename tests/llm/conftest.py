import pytest


@pytest.fixture(autouse=True)
def importable(spark):
    from gaugework.llm.common import importable as let

    let(spark)


@pytest.fixture
def odd_documents(spark):
    """Nulls in every column, empty and blank texts, a long one, repeated rows, and columns with clashing names."""
    long_text = " ".join(f"word{k % 977} the" for k in range(30_000))
    rows = [
        (1, None, None, None), (2, "", "en", "src0"), (3, "   \n\t ", "en", None), (None, "a lonely text without id and some more words here", None, "src1"),
        (4, long_text, "en", "src0"), (5, "The quick brown fox jumps over the lazy dog again and again.", "en", "src1"),
        (5, "The quick brown fox jumps over the lazy dog again and again.", "en", "src1"), (6, "123 456 !!!", "de", "src2"), (7, "é ß ñ 漢字 ☃", "fr", "src3"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    clash = ["n_words", "size", "shard", "slot", "kept", "fail_bits", "words", "h", "score", "node", "ids", "start", "EPOCH", "salt", "N_PII", "__w", "__l", "__h", "__d", "__t", "__range", "__row", "__pii", "__found", "__domain", "__salt", "__words", "key", "label", "t", "id", "lang_pred"]
    return df.select("*", *[__import__("pyspark").sql.functions.lit("x").alias(c) for c in clash])
