import pytest
from pyspark.sql import Row

SF001 = "/root/testdata/sf0.001"

LONG = "the license and of " * 12_000
TEXTS = [None, "", "   \n\t ", "one", "two words", "A quick brown fox jumps over the lazy dog near the old river bank today",
         "A quick brown fox jumps over the lazy dog near the old river bank today", "Ünïcode ÉCOLE straße 東京 😀 text here",
         "!!! ??? ###", "line one.\nline two.\n\nline two.", LONG]


@pytest.fixture(scope="session")
def edge(spark):
    """Awkward rows: NULLs in every column, empty and very long texts, repeated rows, clashing extra columns."""
    rows = [Row(doc_id=i, text=t, lang="en", source="a", n_chars=None, score="s", key="k", words="w", part="p", rid=1, held_out="h")
            for i, t in enumerate(TEXTS)]
    rows += [rows[5], rows[5], Row(**{**rows[3].asDict(), "doc_id": None, "lang": None, "source": None}),
             Row(**{**rows[0].asDict(), "doc_id": None, "lang": None, "source": None, "score": None})]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string, "
                                       "key string, words string, part string, rid int, held_out string")


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.read.parquet(f"{SF001}/benchmark.parquet")
