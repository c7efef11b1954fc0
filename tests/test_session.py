"""Where intermediate tables go."""

from types import SimpleNamespace

import pytest

from tallyforge import session


def fake(master, configured=None, checkpoints=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: configured if key == "spark.checkpoint.dir" else default),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoints),
    )


def test_the_configured_folder_wins():
    assert session.shared_dir(fake("yarn", "hdfs://store/chk/")) == "hdfs://store/chk"
    one, two = (session.fresh_path(fake("yarn", "hdfs://store/chk"), "t") for _ in range(2))
    assert one.startswith("hdfs://store/chk/t-") and one != two


def test_a_checkpoint_folder_set_on_the_context_counts():
    assert session.shared_dir(fake("yarn", checkpoints="hdfs://store/own")) == "hdfs://store/own"


def test_only_a_local_master_may_use_its_own_folder():
    assert session.shared_dir(fake("local[4]")) == session.shared_dir(fake("local[4]"))
    with pytest.raises(RuntimeError):
        session.shared_dir(fake("spark://cluster:7077"))


def test_checkpoints_work(spark):
    session.ensure_checkpoints(spark)
    assert spark.range(5).checkpoint().count() == 5
