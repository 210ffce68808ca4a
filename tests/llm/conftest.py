import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"

LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
ODD = [(None, "a text without an id that has quite a few words in it"), (7, None), (8, ""), (9, " \n\t "), (10, LONG), (11, "one two"),
       (12, "same words here and there and everywhere"), (13, "same words here and there and everywhere"),
       (12, "same words here and there and everywhere"), (14, "ünïcode Ärger 😀 straße \u0001 \\ | %")]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Null id and text, empty, blank, very long, short, equal and repeated rows; columns with clashing names."""
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    extra = ["row", "id", "units", "version", "repeats", "contamination", "language", "rate", "copy", "copies", "shuffle_key", "codes", "n", "digest",
             "window", "s", "p", "label", "u", "excerpt", "range", "tree", "component", "kept"]
    return df.withColumns({c: F.lit(1) for c in extra} | {"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long")})


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
