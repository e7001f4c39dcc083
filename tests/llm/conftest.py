import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = "the cat of the house and the dog of the yard ran to a gate in may then sat by an oak as rain fell on tin roofs near red barns while old men told long tales about seven ships lost at sea in spring storms when nobody kept watch over lights"


def edge_rows():
    """Nulls, empty, blank, very long, equal and repeated rows."""
    long = " ".join(f"{PROSE.split()[i % 47]}{i % 977}" for i in range(30_000))
    near = PROSE + " and then some more words follow here that are new"
    return [
        (1, PROSE, "en", "a", 1), (2, PROSE.replace(" ", "\t\n "), "en", "a", 1), (3, None, None, None, None), (4, "", "en", "b", 0),
        (5, " \n\t ", "en", "b", 4), (6, long, "de", "b", 1), (7, "two words", "en", "b", 1), (8, "Two words", "en", None, 1),
        (9, PROSE.upper(), "en", "a", 1), (9, PROSE.upper(), "en", "a", 1), (None, "no id here", "en", "a", 1), (10, near, "en", "c", 1),
        (11, "x" * 70_000, "en", "c", 1), (12, "中文 \U0001f600 été  \r\n a", "zh", "c", 1), (13, "!!! ### $$$ " * 60, "en", "c", 1),
    ]


@pytest.fixture(scope="session")
def edge(spark, tmp_path_factory):
    """The edge rows with an extra column whose name clashes with columns that operators return."""
    from tallyspark.llm.common import importable

    importable(spark)
    path = str(tmp_path_factory.mktemp("edge") / "documents.parquet")
    clash = ["kept", "score", "digest", "root", "n", "__r", "slot", "ids", "file", "row", "label"]
    spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).withColumns({c: F.lit("x") for c in clash}).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty") / "documents.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)
