from __future__ import annotations

from types import SimpleNamespace

import pytest

from tidemark import session


def test_staged_tables_go_to_the_configured_folder(spark):
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == base
    first, second = (session.new_stage_path(spark, "x") for _ in range(2))
    assert first.startswith(f"{base}/x-") and first != second


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, key, default=None):
            return default

    context = SimpleNamespace(master="yarn", getConf=Conf, applicationId="a")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(SimpleNamespace(sparkContext=context, conf=Conf()))


def test_shuffles_start_with_partitions_for_the_input(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert session.size_shuffles(spark, 10 * session.TARGET_PARTITION_BYTES + 1) == 11
    assert spark.conf.get(key) == "11"
    assert session.size_shuffles(spark, 10**18, most=1000) == 1000
    assert session.size_shuffles(spark, 10**14) > 100_000
    assert session.size_shuffles(spark, 0) == spark.sparkContext.defaultParallelism


def test_path_bytes(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"12345")
    assert session.path_bytes(spark, str(tmp_path / "a")) == 5
    assert session.path_bytes(spark, str(tmp_path / "none")) == 0


def test_month_partitions_stay_text(spark, tmp_path):
    spark.range(1).selectExpr("id", "'04' AS month").write.partitionBy("month").parquet(str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).first().month == "04"
