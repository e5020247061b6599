import pytest
from pyspark.sql import SparkSession

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    built = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "6g").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").getOrCreate()
    built.sparkContext.setLogLevel("ERROR")
    return built


@pytest.fixture(scope="session")
def sf():
    return SF


#: Texts every operator has to stand: null, empty, blank, one word, ties, non-ASCII, very long.
ODD = [None, "", "   \n\t ", "word", "a b", "Ünïcode ÉÉ 日本語 😀 é", "x" * 300_000, "same words again " * 20_000, "same words again " * 20_000, "tab\tnew\nline\r\nend", "▁ mark"]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd texts with repeated rows, a null id, nulls in other columns and columns with clashing names."""
    rows = [(i, t, None if i % 2 else "en", None if i % 3 else "s", None if i % 2 else len(t or ""), "row", 1) for i, t in enumerate(ODD)]
    rows += [rows[3], (None, "no id here", "de", "s", 3, "n", 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, words string, n int")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")
