from __future__ import annotations

import pytest

from quayside import session
from quayside.session import CHECKPOINT_DIR, scratch_dir


class Settings:
    """A session with other settings than the one of the tests."""

    def __init__(self, settings, default_fs=None):
        self.settings, self.default_fs = settings, default_fs

    @property
    def conf(self):
        return self

    def get(self, key, default=None):
        if key == "fs.defaultFS":
            return self.default_fs
        return self.settings.get(key, default)

    @property
    def sparkContext(self):  # noqa: N802
        return self

    _jsc = property(lambda self: self)

    def hadoopConfiguration(self):  # noqa: N802
        return self


def test_folder_of_the_default_file_system():
    spark = Settings({"spark.master": "yarn", CHECKPOINT_DIR: "/shared/ck"}, "hdfs://nn:8020")
    assert scratch_dir(spark, "x").startswith("hdfs://nn:8020/shared/ck/quayside/x-")
    local = Settings({"spark.master": "local[2]", CHECKPOINT_DIR: "/shared/ck"}, "file:///")
    assert scratch_dir(local, "x").startswith("file:///shared/ck/quayside/x-")


def test_disks_of_machines_are_refused_on_a_cluster():
    for settings in ({}, {CHECKPOINT_DIR: "/shared/ck"}):
        with pytest.raises(ValueError, match=CHECKPOINT_DIR):
            scratch_dir(Settings({"spark.master": "spark://h:1", **settings}, "file:///"), "x")
    shared = Settings({"spark.master": "spark://h:1", CHECKPOINT_DIR: "file:///mount/ck"}, "file:///")
    assert scratch_dir(shared, "x").startswith("file:///mount/ck/quayside/x-")


def test_local_session_without_the_setting(monkeypatch, tmp_path):
    monkeypatch.setattr(session, "_local_scratch", [])
    monkeypatch.setattr(session.tempfile, "mkdtemp", lambda prefix: str(tmp_path / "own"))
    spark = Settings({"spark.master": "local[*]"}, "file:///")
    one, two = scratch_dir(spark, "a"), scratch_dir(spark, "b")
    assert one != two and one.startswith(f"file://{tmp_path}/own/") and two.startswith(f"file://{tmp_path}/own/")


def test_executors_of_a_local_cluster_share_the_disk(monkeypatch, tmp_path):
    """All processes of a local cluster run on this machine, so a folder without a scheme is a shared one."""
    named = Settings({"spark.master": "local-cluster[3,2,3000]", CHECKPOINT_DIR: "/shared/ck"}, "file:///")
    assert scratch_dir(named, "x").startswith("file:///shared/ck/quayside/x-")
    monkeypatch.setattr(session, "_local_scratch", [])
    (tmp_path / "own").mkdir()
    (tmp_path / "link").symlink_to(tmp_path / "own")
    monkeypatch.setattr(session.tempfile, "mkdtemp", lambda prefix: str(tmp_path / "link"))
    spark = Settings({"spark.master": "local-cluster[3,2,3000]"}, "file:///")
    assert scratch_dir(spark, "a").startswith(f"file://{tmp_path}/own/")


def test_the_session_of_the_tests_knows_its_file_system(spark):
    assert session.default_file_system(spark).startswith("file:")
