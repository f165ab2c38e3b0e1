import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, source]) rows, with extra columns whose
    names the operators use inside."""
    def make(rows, extra=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        if extra:
            for name in ("th", "d", "size", "start", "h", "gone", "p", "words", "fp", "root", "block"):
                df = df.withColumn(name, F.lit(f"extra {name}"))
        return df
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and blank texts, a very long text, ties and
    repeated rows."""
    long = " ".join(f"w{i % 9973}" for i in range(60_000))
    return [(1, "one two three four five six"), (2, None), (3, ""), (4, " \t\n "), (None, "one two three four five six"), (None, None),
            (5, long), (6, "same text here"), (6, "same text here"), (7, "same text here"), (8, "x", None), (9, "x\ny\nz\n\nx\ny\nz", None)]
