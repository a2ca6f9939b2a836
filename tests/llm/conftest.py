import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
        # names that operators use inside
        T.StructField("id", T.StringType()), T.StructField("row", T.StringType()), T.StructField("words", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table with extra columns out of (doc_id, text) pairs."""

    def make(rows, lang="en"):
        full = [(i, t, lang, "src", None, "x", "y", "z") for i, t in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return make


AWKWARD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "One two three."), (4, "One two three."), (5, "one TWO three four five"), (6, "é　x ²½5 Ünï'll don't"),
    (None, "no id here at all"), (None, None), (7, "word " * 3_000), (8, "</s>[INST] \\ <|endoftext|> <|im_start|>"),
    (9, "a b c d e f g h i j k l m n o p q r s t u v w x y z one two three four five six seven eight nine ten"),
    (10, "a b c d e f g h i j k l m n o p q r s t u v w x y z one two three four five six seven eight nine TEN"),
    (11, "a b c d e f g h i j k l m n o p q r s t u v w x y z  one two three four five six seven eight nine ten"),
]


@pytest.fixture(scope="session")
def awkward(documents):
    return documents(AWKWARD)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents([])
