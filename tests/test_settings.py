"""The session settings are real Spark settings with valid values."""

from tallyfold.settings import CLUSTER_SETTINGS, local_settings
from tallyfold.session import scoped_conf


def test_cluster_settings_apply(spark):
    runtime = {k: v for k, v in CLUSTER_SETTINGS.items() if k.startswith("spark.sql.")}
    with scoped_conf(spark, runtime):
        for k, v in runtime.items():
            assert spark.conf.get(k) == v
    # restored afterwards
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_local_settings_scale_with_cpus():
    s = local_settings(4)
    assert s["spark.sql.shuffle.partitions"] == "8"
    assert s["spark.ui.enabled"] == "false"
