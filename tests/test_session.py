import pytest

from cardamom import session


def test_shuffle_partitions_follow_the_input():
    assert session.shuffle_partitions_for(0) == 8
    assert session.shuffle_partitions_for(10**9) == 8
    assert session.shuffle_partitions_for(100 * 10**12) == 745059


def test_scratch_goes_to_the_named_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = session.shared_dir(spark, "x"), session.shared_dir(spark, "x")
    assert one.startswith(f"{root}/x-") and one != two


class FakeSession:
    """A session off the local master with no folder named."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "yarn"
        applicationId = "app"


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(FakeSession(), "x")


def test_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert spark.conf.get("spark.ui.enabled") == "false"
