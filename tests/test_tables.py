"""Landing, Bronze loads and maintenance on disk."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators import edits
from tidemark.sinks import catalog, tables
from tidemark.sources import landing

SCHEMA = "k int, v string, dt date, batch int"


def day(n):
    return dt.date(2024, 1, n)


@pytest.fixture
def feed(spark):
    return spark.createDataFrame(
        [(1, "a", day(1), 1), (2, "b", day(1), 1), (3, "c", day(1), 2), (4, "d", day(2), 1)], SCHEMA
    )


def test_write_batch_replaces_its_folder(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert tables.write_batch(df, str(tmp_path), "t", "2024-01-01", 1, files=3) == 2
    assert tables.write_batch(df.where("k = 1"), str(tmp_path), "t", "2024-01-01", 1) == 1
    assert tables.write_batch(df, str(tmp_path), "t", "2024-01-02", 1) == 2
    got = landing.landed(spark, str(tmp_path), "t")
    assert rows(got, "k", "dt", "batch") == [
        (1, day(1), 1), (1, day(2), 1), (2, day(2), 1)
    ]


def test_read_partitioned_prunes(spark, tmp_path, feed, rows, plan):
    path = tables.land(feed, str(tmp_path), "t")
    assert rows(landing.read_partitioned(spark, path, "2024-01-01", 2), "k") == [(3,)]
    assert len(rows(landing.read_partitioned(spark, path, ["2024-01-01", "2024-01-02"]), "k")) == 4
    assert rows(landing.read_partitioned(spark, path, batch=[2]), "k") == [(3,)]
    text = plan(landing.read_partitioned(spark, path, "2024-01-01", 2))
    filters = text.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "dt#" in filters and "batch#" in filters


def test_next_batch(spark, tmp_path, feed):
    root = str(tmp_path)
    assert landing.next_batch(spark, root, "2024-01-01", "t") == 1
    tables.land(feed, root, "t")
    assert landing.next_batch(spark, root, "2024-01-01", "t") == 3
    assert landing.next_batch(spark, root, "2024-01-02", "t") == 2
    assert landing.next_batch(spark, root, "2024-01-09", "t") == 1


def test_bronze_load_is_idempotent_and_guarded(spark, tmp_path, feed, rows):
    target = str(tmp_path / "bronze")
    tables.load_bronze(feed, target)
    once = rows(spark.read.parquet(target), "k", "v", "dt", "batch")
    tables.load_bronze(feed, target)
    assert rows(spark.read.parquet(target), "k", "v", "dt", "batch") == once
    where = tables.replace_predicate("dt = '{run_dt}'", "2024-01-02")
    with pytest.raises(PySparkException, match="outside replace_where"):
        tables.load_bronze(feed, target, replace_where=where)
    assert rows(spark.read.parquet(target), "k", "v", "dt", "batch") == once
    one_day = feed.where("dt = '2024-01-02'").withColumn("v", F.lit("z"))
    tables.load_bronze(one_day, target, replace_where=where)
    assert rows(spark.read.parquet(target), "k", "v")[3] == (4, "z")
    tables.load_bronze(feed.where("false"), target)
    assert spark.read.parquet(target).count() == 4


def test_replace_predicate_wants_a_date():
    with pytest.raises(ValueError):
        tables.replace_predicate("dt = '{run_dt}'", "2024-01-01' OR '1'='1")


def test_upsert_touches_only_its_dates(spark, tmp_path, feed, rows):
    path = str(tmp_path / "t")
    tables.full_refresh(feed, path, ["dt"])
    untouched = sorted(p.name for p in (tmp_path / "t" / "dt=2024-01-02").iterdir())
    changes = spark.createDataFrame([(1, "new", day(1), 9), (9, "add", day(1), 9)], SCHEMA)
    assert tables.upsert_partitions(spark, changes, path, ["k"]) == [day(1)]
    assert rows(spark.read.parquet(path), "k", "v") == [
        (1, "new"), (2, "b"), (3, "c"), (4, "d"), (9, "add")
    ]
    assert untouched == sorted(p.name for p in (tmp_path / "t" / "dt=2024-01-02").iterdir())
    assert tables.upsert_partitions(spark, changes.where("false"), path, ["k"]) == []


def test_upsert_moves_a_key_to_another_date(spark, tmp_path, feed, rows):
    path = str(tmp_path / "t")
    tables.full_refresh(feed, path, ["dt"])
    moved = spark.createDataFrame([(1, "moved", day(2), 9), (4, "d2", day(3), 9)], SCHEMA)
    assert tables.upsert_partitions(spark, moved, path, ["k"]) == [day(1), day(2), day(3)]
    table = landing.read_partitioned(spark, path)
    assert rows(table, "k", "v", "dt") == [
        (1, "moved", day(2)), (2, "b", day(1)), (3, "c", day(1)), (4, "d2", day(3))
    ]
    back = spark.createDataFrame([(1, "back", day(1), 9)], SCHEMA)
    assert tables.upsert_partitions(spark, back, path, ["k"]) == [day(1), day(2)]
    assert rows(landing.read_partitioned(spark, path), "k", "dt")[0] == (1, day(1))
    assert not (tmp_path / "t" / "dt=2024-01-02").exists()


def test_rewrite_and_compact(spark, tmp_path, feed, rows):
    path = str(tmp_path / "t")
    feed.repartition(4).write.partitionBy("dt").parquet(path)
    tables.rewrite_partitions(
        spark, path, ["2024-01-01"],
        lambda df: edits.updated(df, F.col("k") == 1, {"v": F.concat("v", F.lit("!"))}),
    )
    assert rows(spark.read.parquet(path), "k", "v")[0] == (1, "a!")
    tables.compact(spark, path, ["2024-01-01"])
    assert len(list((tmp_path / "t" / "dt=2024-01-01").glob("*.parquet"))) == 1
    assert spark.read.parquet(path).count() == 4


def test_edits_treat_null_as_no_match(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    gone = edits.without(df, F.col("v") == "a")
    assert rows(gone) == [(2, None)]
    changed = edits.updated(df, F.col("v") == "a", {"k": F.col("k") + 10, "v": F.col("k")})
    assert rows(changed) == [(11, "1"), (2, None)]


def test_partition_drop_goes_on_after_an_error(spark, feed):
    feed.write.mode("overwrite").partitionBy("dt").format("parquet").saveAsTable("drop_me")
    outcome = catalog.drop_partitions(spark, ["no_such_table", "drop_me"], "2024-01-01")
    assert outcome["drop_me"] is None and outcome["no_such_table"]
    assert [r.k for r in spark.table("drop_me").collect()] == [4]
    catalog.drop_partitions(spark, ["drop_me"], "2024-01-01")
    spark.sql("DROP TABLE drop_me")


def test_file_counts():
    assert tables.files_for(0) == 1
    assert tables.files_for(128 * 1024 * 1024) == 1
    assert tables.files_for(10 * 2**40) == 81920


def test_sources_by_format(spark, tmp_path, feed):
    for name in ("PARQUET", "CSV", "JSON"):
        path = str(tmp_path / name)
        feed.write.format(landing.FORMATS[name]).save(path)
        assert landing.read_source(spark, name, path, feed.schema).count() == 4
    with pytest.raises(Exception, match="DATA_SOURCE_NOT_FOUND"):  # its package is not here
        landing.read_source(spark, "DELTA", str(tmp_path / "x"))
    with pytest.raises(ValueError):
        landing.read_source(spark, "XML", str(tmp_path / "x"))


def test_paths():
    assert landing.resolve_path("/r/{table}/dt={run_dt}/", "t", "2024-01-01") == "/r/t/dt=2024-01-01/"
    assert landing.resolve_path("{root}/{source_table}/dt={dt}/batch={batch}", "t", "d", 3, "/r") == (
        "/r/t/dt=d/batch=3"
    )


def test_lineage_and_rows_since(spark, tmp_path, feed, plan):
    path = tables.land(feed, str(tmp_path), "t")
    stamped = landing.stamp_lineage(spark.read.parquet(path), "r1")
    row = stamped.where("k = 3").first()
    assert row[landing.RUN_ID] == "r1" and "dt=2024-01-01/batch=2" in row[landing.SOURCE_FILE]
    fresh = landing.rows_since(spark.read.parquet(path), "dt", "2024-01-01")
    assert [r.k for r in fresh.collect()] == [4]
    assert "dt#" in plan(fresh).split("PartitionFilters: [")[1].split("]")[0]
    assert landing.rows_since(feed, "dt", None).count() == 4
    assert landing.has_rows(fresh) and not landing.has_rows(fresh.where("k > 9"))


def test_catalog_tables(spark):
    catalog.create_layers(spark, "lk_")
    names = catalog.create_metadata_tables(spark, "lk_metadata")
    assert len(names) == 6
    described = catalog.describe(spark, "lk_metadata")
    assert described.select("table_name").distinct().count() == 6
    log = "lk_metadata.etl_process_log"
    row = spark.createDataFrame([("l1", "r1", 7, "t", "STARTED")],
                                "log_id string, run_id string, table_id int, table_name string, status string")
    catalog.insert_rows(row, log)
    catalog.insert_rows(row.withColumn("log_id", F.lit("l2")), log)
    catalog.replace_rows(
        edits.updated(spark.table(log), F.col("log_id") == "l2",
                      {"status": F.lit("SUCCESS"), "rows_written": F.lit(5)}), log)
    spark.catalog.refreshTable(log)
    got = {r.log_id: (r.status, r.rows_written) for r in spark.table(log).collect()}
    assert got == {"l1": ("STARTED", None), "l2": ("SUCCESS", 5)}
    found = catalog.query(spark, f"SELECT count(*) AS n, :x AS x FROM {log} WHERE status = :s",
                          s="SUCCESS", x=None).first()
    assert (found.n, found.x) == (1, None)
    catalog.drop_metadata_tables(spark, "lk_metadata")
    assert not spark.catalog.listTables("lk_metadata")


def test_incremental_load_without_partitions(spark, tmp_path, feed, rows):
    target = str(tmp_path / "flat")
    with pytest.raises(ValueError, match="partition columns or replace_where"):
        tables.load_bronze(feed, target, ())
    for n in (1, 2, 2):
        where = f"dt = DATE '2024-01-0{n}'"
        tables.load_bronze(feed.where(where), target, (), where)
    assert rows(landing.read_partitioned(spark, target), "k") == [(1,), (2,), (3,), (4,)]
    where = "k = 3 AND dt = DATE '2024-01-01'"
    tables.load_bronze(feed.where("false"), target, (), where)
    assert rows(landing.read_partitioned(spark, target), "k") == [(1,), (2,), (4,)]


def test_replaced_predicate_leaves_nothing_behind(spark, tmp_path, feed, rows):
    target = str(tmp_path / "t")
    tables.load_bronze(feed, target, ["dt", "batch"])
    where = "dt = DATE '2024-01-01'"
    tables.load_bronze(feed.where("k = 1"), target, ["dt", "batch"], where)
    assert rows(landing.read_partitioned(spark, target), "k", "batch") == [(1, 1), (4, 1)]
    # a predicate over another column rewrites rows, not folders
    tables.load_bronze(feed.where("k = 4").withColumn("v", F.lit("n")), target, ["dt", "batch"], "k = 4")
    assert rows(landing.read_partitioned(spark, target), "k", "v") == [(1, "a"), (4, "n")]


def test_columns_that_came_later_survive(spark, tmp_path, feed, rows):
    target = str(tmp_path / "t")
    tables.load_bronze(feed.where("dt = '2024-01-01'"), target)
    wider = feed.where("dt = '2024-01-02'").withColumn("w", F.lit(7))
    tables.load_bronze(wider, target)
    expected = [(1, None), (2, None), (3, None), (4, 7)]
    tables.compact(spark, target, ["2024-01-01", "2024-01-02"])
    assert rows(landing.read_partitioned(spark, target), "k", "w") == expected
    tables.rewrite_partitions(spark, target, ["2024-01-02"], lambda df: df)
    assert rows(landing.read_partitioned(spark, target, ["2024-01-02"]), "k", "w") == [(4, 7)]
    # older dates loaded later do not narrow the table again
    tables.load_bronze(feed.where("k = 1"), target)
    assert landing.table_schema(spark, target).fieldNames() == ["k", "v", "dt", "batch", "w"]
    changes = spark.createDataFrame([(4, "x", day(2), 1, "new")], "k int, v string, dt date, batch int, extra string")
    tables.upsert_partitions(spark, changes, target, ["k"])
    assert rows(landing.read_partitioned(spark, target, "2024-01-02"), "k", "w", "extra") == [(4, None, "new")]
    with pytest.raises(ValueError, match="not what the table has"):
        tables.append(feed.withColumn("w", F.lit("text")), target, ["dt"])


def test_deleting_every_row_of_a_date_drops_it(spark, tmp_path, feed, rows):
    target = str(tmp_path / "t")
    tables.full_refresh(feed, target, ["dt"])
    tables.rewrite_partitions(spark, target, ["2024-01-01"], lambda df: edits.without(df, F.lit(True)))
    assert rows(landing.read_partitioned(spark, target), "k") == [(4,)]


def test_work_folders_are_removed(spark, tmp_path, feed):
    from pathlib import Path

    from tidemark.session import work_root

    target = str(tmp_path / "t")
    tables.full_refresh(feed, target, ["dt"])
    tables.upsert_partitions(spark, feed, target, ["k"])
    tables.compact(spark, target, ["2024-01-01"])
    root = Path(work_root(spark).removeprefix("file:"))
    assert not [p.name for p in root.iterdir() if p.name.split("-")[0] in ("changes", "upsert", "rewrite")]


def test_more_partitions_than_open_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "_OPEN_FILES", 2)
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before, seen = spark.conf.get(name, "0"), []
    df = spark.range(1000, numPartitions=3).selectExpr("id", "cast(id % 7 as int) AS part")
    with tables._open_files(spark):
        seen.append(spark.conf.get(name))
    for _ in range(2):
        tables.load_bronze(df, str(tmp_path / "t"), ["part"])
        tables.full_refresh(df, str(tmp_path / "u"), ["part"])
    assert seen == ["2"] and spark.conf.get(name) == before
    for folder in ("t", "u"):
        stored = spark.read.parquet(str(tmp_path / folder))
        assert {tuple(r) for r in stored.select("id", "part").collect()} == {(n, n % 7) for n in range(1000)}
        assert stored.count() == 1000
