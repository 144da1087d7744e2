from __future__ import annotations

import pytest

from bazaarlake import session


@pytest.mark.parametrize(
    "setting,size", [("10485760b", 10485760), ("10MB", 10485760), ("64", 64), ("1t", 1 << 40), ("-1", -1)]
)
def test_size_settings(spark, conf, setting, size):
    conf(autoBroadcastJoinThreshold=setting)
    assert session.setting_bytes(spark, "spark.sql.autoBroadcastJoinThreshold") == size


def test_written_tables_can_be_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "scratch_root", lambda _: str(tmp_path / "scratch"))
    assert session.written(spark.range(5), "five").count() == 5
    assert len(list((tmp_path / "scratch").iterdir())) == 1
    session.drop_scratch(spark)
    assert not (tmp_path / "scratch").exists()


class ClusterSession:
    class sparkContext:
        master = "yarn"
        applicationId = "app"

    class conf:
        @staticmethod
        def get(key, default=None):
            return default


def test_the_folder_the_cluster_names_is_used(monkeypatch):
    monkeypatch.setattr(ClusterSession.conf, "get", lambda key, default=None: f"hdfs:/{key}")
    assert session.scratch_path(ClusterSession, "x").startswith(
        "hdfs:/spark.checkpoint.dir/bazaarlake/app/x-"
    )


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_path(ClusterSession, "x")
