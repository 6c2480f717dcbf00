import pytest

SCHEMA = "doc_id bigint, text string"
EXTRA = ("n_words", "kept", "rank", "bucket", "value", "component_id", "row", "word", "task")


@pytest.fixture
def docs(spark):
    """Rows to a frame; ``extra`` adds columns whose names operators use."""
    def make(rows, extra=True):
        df = spark.createDataFrame(rows, SCHEMA)
        if extra:
            from pyspark.sql import functions as F
            for name in EXTRA:
                df = df.withColumn(name, F.lit("x"))
        return df.repartition(3)
    return make


@pytest.fixture
def odd_rows():
    """Nulls, empty and very long texts, repeated rows, a row without an id."""
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two"), (6, "a b c d e"),
            (6, "a b c d e"), (7, "a b c d e"), (8, "wort " * 60_000), (9, "x" * 200_000),
            (None, "a b c d e"), (10, "é 東 🙂 ▁ <|endoftext|> \x1c\x85　end")]
