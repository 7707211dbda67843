from tidemark.sinks import tables
from tidemark.streaming.arrivals import load_arrivals

SCHEMA = "k int, dt date, batch int"


def test_only_new_dates_are_loaded(spark, tmp_path, rows):
    root, target, offsets = (str(tmp_path / n) for n in ("land", "bronze", "offsets"))
    feed = spark.sql(
        "SELECT * FROM VALUES (1, DATE'2024-01-01', 1), (2, DATE'2024-01-02', 1), "
        "(3, DATE'2024-01-02', 2) AS t(k, dt, batch)"
    )
    schema = feed.schema

    def arrive(batch):
        tables.land(feed.where(f"batch = {batch}"), root, "t")
        return load_arrivals(spark, root, "t", schema, target, offsets, f"run-{batch}", max_files=1)

    assert arrive(1) == ["2024-01-01", "2024-01-02"]
    # the second delivery of a date must not push out the first
    assert arrive(2) == ["2024-01-02"]
    assert rows(spark.read.parquet(target), "k", "_ingestion_run_id") == [
        (1, "run-1"), (2, "run-1"), (3, "run-2")
    ]
    assert load_arrivals(spark, root, "t", schema, target, offsets, "run-3") == []
