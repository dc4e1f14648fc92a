"""Headers from the starts of files, and landings that are read whole or not at all."""

from __future__ import annotations

import gzip
from pathlib import Path

import pytest
from frames import GOOD, bronze
from pyspark.sql import functions as F

from assay import landings
from assay.plans import bronze_to_silver, bronze_to_silver_basic, run_medallion
from assay.schemas import BRONZE, SILVER, Layout
from assay.sinks import land_bronze
from assay.sources import find_bronze, read_bronze_csv, read_layer
from assay.sources.bronze import file_header
from assay.workspace import Files

HEADER = ",".join(BRONZE.names)
ROW = "2024-01-05,101,US,Widget A,3,9.99"


def _ids(df):
    return sorted(r["order_id"] for r in df.collect())


def test_blank_lines_before_a_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"\n  \n{HEADER}\n1,{ROW}\n")
    assert _ids(read_bronze_csv(spark, str(tmp_path))) == ["1"]
    (tmp_path / "b.csv").write_text(f"{HEADER}\n2,{ROW}\n")
    (tmp_path / "c.csv").write_text(f"\r\n{','.join(reversed(BRONZE.names))}\r\n9.99,3,W,US,101,2024-01-05,3\r\n")
    (tmp_path / "d.csv").write_bytes(b"\xef\xbb\xbf" + f"{HEADER}\n4,{ROW}\n".encode())
    (tmp_path / "e.csv").write_text("\n \n")
    (tmp_path / "f.csv.gz").write_bytes(gzip.compress(f"\n{HEADER}\n6,{ROW}\n".encode()))
    assert _ids(read_bronze_csv(spark, str(tmp_path))) == ["1", "2", "3", "4", "6"]


def test_a_header_without_names_raises(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f",,\n1,{ROW}\n")
    with pytest.raises(ValueError, match="without a name"):
        read_bronze_csv(spark, str(tmp_path))


def test_line_breaks_and_long_names_in_a_header(spark, tmp_path):
    files = Files(spark)
    path = tmp_path / "a.csv"
    path.write_text('\n"order_id","a\nb ""c""",x\n1,2,3\n')
    assert file_header(files, str(path), multi_line=True) == ("order_id", 'a\nb "c"', "x")
    long = [f"column_{i:06}" for i in range(9000)]
    path.write_text(",".join(long) + "\n" + "1," * 8999 + "1\n")
    assert file_header(files, str(path)) == tuple(long)
    assert file_header(files, str(path), multi_line=True) == tuple(long)


def test_bytes_read_do_not_grow_with_the_file(spark, tmp_path, monkeypatch):
    for name, rows in (("small", 10), ("large", 60_000)):
        (tmp_path / f"{name}.csv").write_text(f"{HEADER}\n" + f"1,{ROW}\n" * rows)
    read = []
    real = Files.head
    monkeypatch.setattr(Files, "head", lambda self, path, size: (read.append(size), real(self, path, size))[1])
    assert find_bronze(spark, str(tmp_path)).groups().keys() == {tuple(BRONZE.names)}
    assert read == [1 << 15] * 2


def test_landed_runs_need_no_look(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "orders")
    for number in range(3):
        land_bronze(bronze(spark, {"order_id": str(number)}, {}), root, f"2024010{number}_000000")
    monkeypatch.setattr(Files, "head", lambda *_: pytest.fail("a landed file was opened"))
    found = find_bronze(spark, root)
    assert len(found.landed) == 3 and not found.others and found.rows() == 6
    result = bronze_to_silver(root, str(tmp_path / "s"), metrics=True)
    assert result.metrics == {"raw_rows": 6, "clean_rows": 3, "removed_rows": 3}


def test_a_run_that_was_changed_is_looked_at(spark, tmp_path):
    root = tmp_path / "orders"
    folder = Path(land_bronze(bronze(spark, {"order_id": "a"}), str(root), "20240105_000000"))
    (folder / "more.csv").write_text(f"{HEADER}\nb,{ROW}\nc,{ROW}\n")
    found = find_bronze(spark, str(root))
    assert not found.landed and found.rows() == 3
    assert _ids(found.frame()) == ["a", "b", "c"]


def _killed(monkeypatch, spark, root, df, batch):
    """A landing whose files are there, but which was killed before it was whole."""

    class Killed(BaseException):
        pass

    def kill(*_):
        raise Killed

    with monkeypatch.context() as patch:
        patch.setattr(landings, "finish", kill)
        with pytest.raises(Killed):
            land_bronze(df, root, "20240105_000000", batch=batch)


def test_a_killed_landing_is_not_read_and_can_be_retried(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "orders")
    land_bronze(bronze(spark, {"order_id": "old"}), root)
    new = bronze(spark, {"order_id": "new"})
    _killed(monkeypatch, spark, root, new, "b/1")
    assert list(Path(root).glob("run=20240105_000000/part*"))
    for one_header in (False, True):
        assert _ids(read_bronze_csv(spark, root, one_header=one_header)) == ["old"]
    for _ in range(3):
        land_bronze(new, root, batch="b/1")
        assert _ids(read_bronze_csv(spark, root)) == ["new", "old"]
    assert len(list(Path(root).glob("run=*"))) == 2


def test_a_torn_entry_counts_as_none(spark, tmp_path):
    root = tmp_path / "orders"
    land_bronze(bronze(spark, {}), str(root), batch="b")
    entry = root / landings.LANDINGS / "b.landed.json"
    (root / landings.LANDINGS / ".b.landed.json.crc").unlink(missing_ok=True)
    entry.write_text(entry.read_text()[:20])
    assert read_bronze_csv(spark, str(root)).count() == 0
    land_bronze(bronze(spark, {}), str(root), batch="b")
    assert read_bronze_csv(spark, str(root)).count() == 1


def test_a_failed_landing_leaves_no_files(spark, tmp_path):
    root = tmp_path / "orders"
    bad = bronze(spark, {}).withColumn("product", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        land_bronze(bad, str(root), batch="b")
    assert not list(root.glob("run=*"))
    land_bronze(bronze(spark, {}), str(root), batch="b")
    assert [r.asDict() for r in read_bronze_csv(spark, str(root)).collect()] == [GOOD]


def test_a_retried_run_gives_its_rows_once(spark, tmp_path, monkeypatch):
    layout = Layout(str(tmp_path))
    rows = bronze(spark, {"order_id": "1"}, {"order_id": "2"})
    _killed(monkeypatch, spark, layout.bronze, rows, "day 1")
    for _ in range(2):
        results = run_medallion(spark, rows, layout, batch="day 1", metrics=True)
        assert results[1].metrics["raw_rows"] == 2
        bronze_to_silver_basic(read_bronze_csv(spark, layout.bronze), str(tmp_path / "basic"), batch="day 1")
    assert read_layer(spark, str(tmp_path / "basic"), SILVER).count() == 2
