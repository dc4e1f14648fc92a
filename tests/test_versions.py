"""A write that is killed at any point leaves the old layer or the new one."""

from __future__ import annotations

import shutil
from pathlib import Path

import pytest
from frames import silver

from assay import versions
from assay.plans import silver_to_gold_basic
from assay.schemas import GOLD_BASIC, SILVER
from assay.sinks import ALREADY_THERE, WRITTEN, append_layer, compact_layer, write_layer
from assay.sources import layer_folders, read_layer
from assay.workspace import Files

OPERATIONS = ("exists", "make", "delete", "list", "read", "create", "move")


class Killed(BaseException):
    """The process is gone: nothing after it runs, no clean-up either."""


class _Kill:
    """Raises at the n-th file operation and at all later ones; a file being made may be cut off."""

    def __init__(self, monkeypatch, at: int, torn: bool):
        self.left, self.dead = at, False
        for name in OPERATIONS:
            monkeypatch.setattr(Files, name, self._wrapped(getattr(Files, name), torn and name == "create"))

    def _wrapped(self, real, torn: bool):
        def run(files, path, *rest):
            self.left -= 1
            if self.dead or self.left < 0:
                if torn and not self.dead:
                    real(files, path, rest[0][: len(rest[0]) // 2])
                self.dead = True
                raise Killed
            return real(files, path, *rest)

        return run


def _ids(spark, path, schema=SILVER):
    return sorted(str(tuple(r)) for r in read_layer(spark, path, schema).collect())


def _silver(spark, prefix, *countries):
    return silver(spark, *[{"order_id": f"{prefix}{i}", "country": c} for i, c in enumerate(countries)])


WRITES = {
    "flat": lambda df, t: write_layer(df, t),
    "partitioned": lambda df, t: write_layer(df, t, partition_by="country", null_share=0.9),
    "dynamic": lambda df, t: write_layer(df, t, partition_by="country", partition_overwrite="dynamic"),
    "append": lambda df, t: write_layer(df, t, mode="append", partition_by="country"),
    "batch": lambda df, t: append_layer(df, t, batch="b"),
    "basic gold": lambda df, t: silver_to_gold_basic(df, t),
}


@pytest.mark.parametrize(
    "name, torn",
    [("flat", False), ("flat", True), ("dynamic", False), ("append", False), ("batch", False), ("basic gold", False)],
)
def test_killed_after_every_file_operation(spark, tmp_path, name, torn):
    write = WRITES[name]
    schema = GOLD_BASIC if name == "basic gold" else SILVER
    old, new = _silver(spark, "old", "US", "CA", None), _silver(spark, "new", "US", "MX")
    start = str(tmp_path / "start")
    first = WRITES["basic gold"] if name == "basic gold" else WRITES["flat" if name in ("flat", "batch") else "partitioned"]
    first(old, start)
    before = _ids(spark, start, schema)
    whole = str(tmp_path / "whole")
    shutil.copytree(start, whole)
    write(new, whole)
    after = _ids(spark, whole, schema)
    assert before != after
    # A cut-off file matters at the commit alone, which is the only file that is made.
    seen, at = set(), 0
    while True:
        target = str(tmp_path / f"t{at}")
        shutil.copytree(start, target)
        with pytest.MonkeyPatch.context() as patch:
            kill = _Kill(patch, at, torn)
            try:
                write(new, target)
            except Killed:
                pass
        rows = _ids(spark, target, schema)
        assert rows in (before, after), at
        seen.add(rows == after)
        if at % 6 == 0:
            # The next write goes through and leaves no more than two versions.
            write(new, target)
            found = _ids(spark, target, schema)
            assert found == after or (rows == after and name == "append")
            folders = {f for f, _ in Files(spark).list(target)} - {versions.COMMITS}
            assert len(folders) <= 4 and not any(f.startswith("_staging") for f in folders)
        if not kill.dead:
            break
        at += 1
    assert seen == {True, False} and at > 5


def test_the_first_write_killed_leaves_nothing_to_read(spark, tmp_path):
    for at in range(4, 30):
        target = str(tmp_path / f"t{at}")
        with pytest.MonkeyPatch.context() as patch:
            kill = _Kill(patch, at, torn=True)
            try:
                write_layer(silver(spark, {}), target)
            except Killed:
                pass
        if versions.newest_commit(Files(spark), target):
            assert read_layer(spark, target, SILVER).count() == 1
        else:
            assert not versions.is_there(spark, target)
        if not kill.dead:
            return
    raise AssertionError("the write never went through")


def test_an_interrupt_leaves_the_old_layer_and_no_rest(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    write_layer(_silver(spark, "old", "US"), target)

    def interrupted(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(versions, "commit", interrupted)
    with pytest.raises(KeyboardInterrupt):
        write_layer(_silver(spark, "new", "US"), target)
    assert "old0" in _ids(spark, target)[0]
    assert len([p for p in Path(target).iterdir() if p.name.startswith("v-")]) == 1


def test_readers_that_have_begun_finish(spark, tmp_path):
    target = str(tmp_path / "t")
    write_layer(_silver(spark, "a", "US", "CA"), target, partition_by="country")
    begun = read_layer(spark, target, SILVER)
    write_layer(_silver(spark, "b", "US"), target, partition_by="country")
    assert sorted(r["order_id"] for r in begun.collect()) == ["a0", "a1"]


def test_old_versions_go(spark, tmp_path):
    target = str(tmp_path / "t")
    for number in range(5):
        write_layer(_silver(spark, str(number), "US"), target)
    assert len([p for p in Path(target).iterdir() if p.name.startswith("v-")]) == 2
    assert read_layer(spark, target, SILVER).first()["order_id"] == "40"


@pytest.mark.parametrize("partition_by", [None, "country"])
def test_a_plain_folder_is_taken_over(spark, tmp_path, partition_by):
    target = str(tmp_path / "t")
    old = _silver(spark, "old", "US", "CA")
    out = old.write
    (out.partitionBy(partition_by) if partition_by else out).parquet(target)
    assert len(_ids(spark, target)) == 2 and versions.is_there(spark, target)
    # What a killed write leaves.
    _silver(spark, "lost", "FR").write.partitionBy("country").parquet(f"{target}/v-rest")
    assert len(_ids(spark, target)) == 2
    write_layer(_silver(spark, "more", "US"), target, mode="append", partition_by=partition_by)
    assert len(_ids(spark, target)) == 3
    write_layer(_silver(spark, "new", "US"), target, partition_by=partition_by)
    write_layer(_silver(spark, "new", "US"), target, partition_by=partition_by)
    assert len(_ids(spark, target)) == 1
    assert not list(Path(target).glob("*.parquet")) and not list(Path(target).glob("country=*"))


def test_a_batch_is_appended_once(spark, tmp_path):
    target = str(tmp_path / "t")
    for batch, status in (("a", WRITTEN), ("b", WRITTEN), ("a", ALREADY_THERE), ("b", ALREADY_THERE)):
        assert append_layer(_silver(spark, batch, "US", "CA"), target, batch=batch).status == status
    assert len(_ids(spark, target)) == 4 and len(layer_folders(spark, target)) == 2
    assert compact_layer(spark, target, SILVER).rows == 4
    assert len(_ids(spark, target)) == 4 and len(layer_folders(spark, target)) == 1
    append_layer(_silver(spark, "plain", "US"), target)
    assert len(_ids(spark, target)) == 5


def test_appends_to_partitions_and_their_replacement(spark, tmp_path):
    target = str(tmp_path / "t")
    write_layer(_silver(spark, "a", "US", "CA", None), target, partition_by="country")
    write_layer(_silver(spark, "b", "US", None), target, mode="append", partition_by="country")
    assert len(_ids(spark, target)) == 5
    new = _silver(spark, "c", "US")
    write_layer(new, target, partition_by="country", partition_overwrite="dynamic")
    left = sorted(r["order_id"] for r in read_layer(spark, target, SILVER).collect())
    assert left == ["a1", "a2", "b1", "c0"]
    with pytest.raises(ValueError, match="partitioned by"):
        write_layer(new, target, mode="append")


def test_two_writers_cannot_make_one_commit(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    write_layer(_silver(spark, "a", "US"), target)
    real = versions.state

    def slow(files, path):
        found = real(files, path)
        with monkeypatch.context() as patch:
            patch.setattr(versions, "state", real)
            write_layer(_silver(spark, "faster", "US"), path)
        return found

    monkeypatch.setattr(versions, "state", slow)
    with pytest.raises(versions.ConcurrentWrite):
        write_layer(_silver(spark, "slower", "US"), target)
    assert "faster0" in _ids(spark, target)[0]


def test_an_empty_result_is_published_without_the_guard(spark, tmp_path):
    target = str(tmp_path / "t")
    write_layer(_silver(spark, "a", "US"), target, partition_by="country")
    write_layer(_silver(spark, "a", "US").filter("false"), target, partition_by="country", guard=False)
    assert _ids(spark, target) == [] and versions.is_there(spark, target)


def test_a_null_heavy_column_is_no_partition(spark, tmp_path, caplog):
    rows = _silver(spark, "a", "US", None, None, "")
    for share, partition_by in ((0.75, ("country",)), (0.74, ())):
        target = str(tmp_path / f"t{share}")
        result = write_layer(rows, target, partition_by="country", null_share=share)
        assert result.partition_by == partition_by and result.rows == 4
        assert len(_ids(spark, target)) == 4
    assert "3 of 4 rows have no country" in caplog.text
