import pytest

SF = "/root/testdata/sf0.001"

# A table of odd rows: nulls, empty and blank texts, repeated rows, a long word, a long text, other scripts.
ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (4, "one"), (None, "a text without an id, with some words"), (5, "x" * 5000), (6, "the end of the road, and of it all. " * 900),
    (7, "don't  stop now　 '' 's 12² été \U0001f600 中文"), (8, "a text without an id, with some words"), (None, None), (9, "\x00\x1c odd \x85 controls \r\n"),
]


@pytest.fixture
def odd(spark):
    # Columns that clash with names that operators give.
    data = [(i, t, "en", "src0", n, 0.5, True, "v") for n, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, length int, score double, kept boolean, ids string")


@pytest.fixture
def empty(odd):
    return odd.limit(0)


@pytest.fixture
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")
