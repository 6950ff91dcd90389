import pytest

from candlewick import session


def test_scratch_paths_are_below_the_checkpoint_folder(spark):
    one, two = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert one != two and one.startswith(session.shared_dir(spark))
    assert spark.conf.get("spark.checkpoint.dir") in session.shared_dir(spark)


def test_zone(spark):
    session.require_utc(spark)
    spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
    try:
        with pytest.raises(ValueError):
            session.require_utc(spark)
    finally:
        session.use_utc(spark)
    session.require_utc(spark)


class _Remote:
    """A session on a cluster without a checkpoint folder."""

    class sparkContext:  # noqa: N801
        master = "yarn"

        @staticmethod
        def getCheckpointDir():
            return None

    class conf:  # noqa: N801
        @staticmethod
        def get(key, default=None):
            return default


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(_Remote)
