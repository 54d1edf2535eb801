"""Session helpers: shared folder, staging paths, settings."""

from __future__ import annotations

import pytest

from tallyloom.session import BASE_CONF, CLUSTER_CONF, shared_dir, staging_path


def test_shared_dir_comes_from_the_session(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert configured and shared_dir(spark) == configured.rstrip("/")


def test_staging_paths_are_new_each_time(spark):
    a, b = staging_path(spark, "x"), staging_path(spark, "x")
    assert a != b and a.startswith(shared_dir(spark) + "/x-")


def test_session_has_adaptive_execution_and_no_ui(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.sparkContext.getConf().get("spark.ui.enabled") == "false"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_settings_are_public_spark_keys():
    assert all(k.startswith("spark.") for k in {**BASE_CONF, **CLUSTER_CONF})


class _Session:
    """Just what ``shared_dir`` asks of a session on some master, with no folder configured."""

    def __init__(self, master):
        self.sparkContext = self
        self.master = master

    def getConf(self):
        return {}

    def getCheckpointDir(self):
        return None


def test_a_cluster_without_a_shared_folder_is_refused():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            shared_dir(_Session(master))
