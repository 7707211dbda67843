import os
from types import SimpleNamespace

import pytest

from tidemark import session


def fake(application="app-1", **conf):
    settings = SimpleNamespace(get=lambda key, default=None: conf.get(key, default))
    return SimpleNamespace(conf=settings, sparkContext=SimpleNamespace(applicationId=application))


def test_the_named_folder_is_used():
    spark = fake(**{"spark.checkpoint.dir": "hdfs://x/shared/", "spark.master": "yarn"})
    assert session.work_root(spark) == "hdfs://x/shared"
    one, two = (session.work_path(spark, "t") for _ in range(2))
    assert one.startswith("hdfs://x/shared/t-") and one != two


def test_a_cluster_needs_the_setting():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_root(fake(**{"spark.master": "spark://host:7077"}))


def test_a_local_session_gets_one_folder():
    spark = fake("app-local", **{"spark.master": "local[2]"})
    folder = session.work_root(spark)
    assert os.path.isdir(folder) and session.work_root(spark) == folder


def test_staging_computes_once(spark):
    from pyspark.sql import functions as F

    frame = session.staged(spark.range(5).withColumn("u", F.uuid()), "uuids")
    assert frame.collect() == frame.collect() and frame.count() == 5
