import pytest


@pytest.fixture(autouse=True)
def shipped(spark):
    from tidemark.llm.inputs import ship_code

    ship_code(spark)


@pytest.fixture
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture
def frame(spark):
    """``doc_id, text`` rows as a frame of some partitions."""

    def make(rows, more=""):
        return spark.createDataFrame(rows, "doc_id long, text string" + more).repartition(3)

    return make
