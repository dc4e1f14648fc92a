from __future__ import annotations

from pathlib import Path

import pytest

from assay.cluster import session_settings
from assay.workspace import Files, new_folder, shared_base


class FakeSession:
    """Just the settings of a session."""

    def __init__(self, **settings):
        self.settings = {key.replace("_", "."): value for key, value in settings.items()}
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_folders_are_new_and_below_the_shared_one(spark):
    first, second = new_folder(spark), new_folder(spark)
    assert first != second
    assert first.startswith(shared_base(spark) + "/") and Path(first).is_dir()


def test_the_folder_the_cluster_names_is_used():
    named = FakeSession(spark_checkpoint_dir="hdfs:///shared/", spark_master="yarn")
    assert shared_base(named) == "hdfs:///shared"


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_base(FakeSession(spark_master="yarn"))


def test_local_mode_without_shared_folder():
    assert Path(shared_base(FakeSession(spark_master="local[2]"))).is_dir()


@pytest.mark.parametrize("input_bytes", [10**7, 10**10, 10**12, 10**14])
def test_shuffle_blocks_and_partitions_stay_of_a_workable_size(input_bytes):
    settings = session_settings(input_bytes, 1000)
    partitions = int(settings["spark.sql.shuffle.partitions"])
    split = int(settings["spark.sql.files.maxPartitionBytes"])
    assert 1000 <= partitions <= 100_000
    assert input_bytes / partitions <= 2 * 2**30
    if input_bytes >= 10**12:
        assert split / partitions >= 16 * 2**10
    # One map task for each core at least, once there is data for it.
    assert split * 1000 <= max(input_bytes, 1000 * 128 * 2**20)


def test_settings_of_small_data():
    settings = session_settings(10**7, 8)
    assert settings["spark.sql.shuffle.partitions"] == "8"
    assert settings["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "true"
    assert settings["spark.sql.adaptive.enabled"] == "true"


def test_expanded_data_gets_more_partitions_but_no_larger_splits():
    plain, wide = session_settings(10**13, 1000), session_settings(10**13, 1000, expansion=3.0)
    count = "spark.sql.shuffle.partitions"
    assert int(wide[count]) > 1.5 * int(plain[count])
    assert int(wide["spark.sql.files.maxPartitionBytes"]) <= 2**30


def test_files_can_be_moved_and_deleted(spark, tmp_path):
    files, here = Files(spark), tmp_path / "a"
    files.make(str(here))
    (here / "x").write_text("1")
    files.move(str(here), str(tmp_path / "b" / "c"))
    assert not files.exists(str(here)) and (tmp_path / "b" / "c" / "x").read_text() == "1"
    with pytest.raises(Exception):
        files.move(str(here), str(tmp_path / "d"))
    files.delete(str(tmp_path / "b"))
    assert not (tmp_path / "b").exists()
