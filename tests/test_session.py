"""Where durable intermediate data goes."""

from __future__ import annotations

from unittest.mock import Mock

from caremill.session import durable, shared_dir


def _session(named: str | None) -> Mock:
    """A session whose context remembers its checkpoint folder."""
    session, folder = Mock(), []
    session.conf.get.return_value = named
    session.sparkContext.master = "local[2]"
    session.sparkContext.setCheckpointDir.side_effect = folder.append
    session.sparkContext.getCheckpointDir.side_effect = lambda: folder[-1] if folder else None
    return session


def test_the_cluster_names_the_folder():
    session = _session("hdfs://shared/checkpoints/")
    assert shared_dir(session) == "hdfs://shared/checkpoints"
    session.sparkContext.setCheckpointDir.assert_not_called()


def test_own_folder_only_where_none_is_named():
    session = _session(None)
    assert shared_dir(session) == shared_dir(session)
    session.sparkContext.setCheckpointDir.assert_called_once()


def test_checkpoints_go_there(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    df = durable(spark.range(10))
    assert df.count() == 10 and spark.sparkContext.getCheckpointDir().removeprefix("file:").startswith(named)
