import os
from datetime import date
from decimal import Decimal

import pytest

from shelfledger.plans import pos_ingest
from shelfledger.sources import pos_files, versions

COLUMNS = ["plu_number", "total_qty_sales", "total_sales"]
NUMERIC = COLUMNS[1:]


def _file(root, folder, name, text, age=0):
    path = root / folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    os.utime(path, (1_700_000_000 - age, 1_700_000_000 - age))
    return str(path)


def test_thousands_separators_and_bad_rows(spark, tmp_path):
    path = _file(tmp_path, "f", "a.csv", 'PLU Number,Total Qty-Sales,Total Sales\n1,"1,234.50",2\n2,n/a,3\n3,4\n4,1,2,3\n5,,7\n')
    got = {r.plu_number: r for r in pos_files.read_pos_csv(spark, path, NUMERIC).collect()}
    assert got["1"].total_qty_sales == Decimal("1234.5") and got["1"]._corrupt_record is None
    assert got["2"].total_qty_sales is None and got["2"]._corrupt_record is not None
    assert got["3"]._corrupt_record is not None and got["4"]._corrupt_record is not None
    assert got["5"].total_qty_sales is None and got["5"]._corrupt_record is None
    rejects = pos_files.reject_counts(pos_files.read_pos_csv(spark, path, NUMERIC), ["plu_number"]).agg({"rows_rejected": "sum"})
    assert rejects.first()[0] == 3


def test_one_layout_reader_refuses_another_column_order(spark, tmp_path):
    _file(tmp_path, "f", "a.csv", "A,B\n1,2\n")
    _file(tmp_path, "f", "b.csv", "B,A\n3,4\n")
    with pytest.raises(Exception):
        pos_files.read_pos_csv(spark, str(tmp_path / "f"), [], on_error="fail").collect()


def test_tree_matches_columns_by_header(spark, tmp_path, rows):
    _file(tmp_path, "SRP_202408", "SRP_1216_20240801.csv", 'PLU Number,Total Qty-Sales,Total Sales\n1,"1,000",2\n')
    _file(tmp_path, "SRP_202409", "SRP_1217_20240901.csv", '"Total Sales",Remarks, plu-number \n5,ok,2\n6,"a, b",3,extra\n')
    df = pos_files.with_filename_columns(pos_files.read_csv_tree(spark, str(tmp_path), COLUMNS, NUMERIC))
    got = rows(df.select("location", "date", *COLUMNS))
    assert got == [
        ("1216", date(2024, 8, 1), "1", Decimal("1000"), Decimal(2)),
        ("1217", date(2024, 9, 1), "2", None, Decimal(5)),
        ("1217", date(2024, 9, 1), "3", None, Decimal(6)),
    ]
    bad = [r.plu_number for r in df.collect() if r._corrupt_record]
    assert bad == ["3"]
    everything = pos_files.read_csv_tree(spark, str(tmp_path))
    assert set(everything.columns) >= {"plu_number", "remarks", "total_qty_sales", "total_sales"}


def test_tree_with_one_layout_needs_no_join(spark, tmp_path):
    for n in (1, 2):
        _file(tmp_path, "SRP_202408", f"SRP_121{n}_20240801.csv", f"PLU Number,Total Sales,Total Qty-Sales\n{n},2,3\n")
    for header in (None, ["PLU Number", "Total Sales", "Total Qty-Sales"]):
        df = pos_files.read_csv_tree(spark, str(tmp_path), COLUMNS, NUMERIC, header=header)
        assert "Join" not in df._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.plu_number, int(r.total_qty_sales), int(r.total_sales)) for r in df.collect()) == [("1", 3, 2), ("2", 3, 2)]


def test_newest_file_of_a_name_wins(spark, tmp_path):
    text = "PLU Number,Total Qty-Sales,Total Sales\n1,{},0\n"
    _file(tmp_path, "SRP_202408", "SRP_1216_20240801.csv", text.format(1), age=50)
    _file(tmp_path, "redo/SRP_202408", "SRP_1216_20240801.csv", text.format(2), age=10)
    _file(tmp_path, "SRP_202408", "SRP_1217_20240801.csv", text.format(3), age=90)
    every = pos_ingest.read_drop(spark, str(tmp_path), COLUMNS, NUMERIC)
    assert every.count() == 3
    os.chmod(tmp_path / "SRP_202408/SRP_1216_20240801.csv", 0)  # is not to be opened
    latest = pos_ingest.read_drop(spark, str(tmp_path), COLUMNS, NUMERIC, latest_only=True)
    assert pos_files.latest_files(pos_files.drop_files(spark, str(tmp_path))).count() == 2
    got = latest.collect()
    assert sorted((r.location, int(r.total_qty_sales)) for r in got) == [("1216", 2), ("1217", 3)]


def test_ingest_and_backfill(spark, tmp_path):
    drop, target = tmp_path / "drop", str(tmp_path / "table")
    text = "PLU Number,Total Qty-Sales,Total Sales\n1,{},0\n"
    _file(drop, "SRP_202408", "SRP_1216_20240801.csv", text.format(1))
    pos_ingest.ingest(spark, str(drop), target, COLUMNS, NUMERIC)
    _file(drop, "SRP_202408", "SRP_1217_20240801.csv", text.format(5))
    _file(drop, "SRP_202408", "SRP_1218_20240801.csv", text.format("x"))
    _file(drop, "SRP_202408", "SRP_1216_20240801.csv", text.format(9))  # not asked for
    asked = spark.createDataFrame(
        [(date(2024, 8, 1), 1217), (date(2024, 8, 1), 1218), (date(2024, 8, 2), 1217), (date(2024, 9, 1), 1217)], "date date, location int")
    for _ in range(2):
        status = pos_ingest.backfill(spark, str(drop), target, asked, COLUMNS, NUMERIC, "total_qty_sales")
        assert {(str(r.date), r.location): r.status for r in status.collect()} == {
            ("2024-08-01", "1217"): "Success",
            ("2024-08-01", "1218"): "Verification failed",
            ("2024-08-02", "1217"): "SRP_1217_20240802.csv not found",
            ("2024-09-01", "1217"): "Folder SRP_202409 not found",
        }
        stored = versions.read(spark, target).collect()
        assert sorted((str(r.location), r.total_qty_sales) for r in stored) == [("1216", Decimal(1)), ("1217", Decimal(5)), ("1218", None)]


def test_headers_of_odd_files(spark, tmp_path):
    _file(tmp_path, "a b", "one.csv", "\ufeffA,B C\r\n1,2\r\n")
    _file(tmp_path, "a b", "two.csv", "X" * 10_000 + ",y\n1,2\n")
    _file(tmp_path, "a b", "empty.csv", "")
    _file(tmp_path, "a b", "open.csv", "only-header")
    got = {r.file_path.rsplit("/", 1)[1]: r.names for r in pos_files.file_headers(spark, str(tmp_path)).collect()}
    assert got == {"one.csv": ["a", "b_c"], "two.csv": ["x" * 10_000, "y"], "open.csv": ["only_header"]}


def test_storage_tasks_cannot_open_is_scanned(spark, tmp_path, monkeypatch):
    _file(tmp_path, "f", "a.csv", "A,B\n1,2\n")

    class Closed:
        @staticmethod
        def from_uri(uri):
            raise OSError(uri)

    monkeypatch.setattr(pos_files, "FileSystem", Closed)
    assert [r.names for r in pos_files.file_headers(spark, str(tmp_path)).collect()] == [["a", "b"]]


LINES = '"PLU, Number",Descriptor,Qty\n1,"a ""b"", c",2\n2,x,3,4,5,6\n3,y\n1,,n/a\n7,"open,8\n'


def _read(spark, root, on_error="permissive"):
    df = pos_files.read_csv_tree(spark, str(root), ["plu,_number", "descriptor", "qty"], ["qty"], on_error=on_error)
    return sorted(((r[0], r[1], None if r[2] is None else int(r[2]), r[pos_files.CORRUPT]) for r in df.collect()), key=repr)


def test_quoted_headers_and_whole_reject_lines(spark, tmp_path):
    _file(tmp_path, "a", "x.csv", LINES)
    one = _read(spark, tmp_path)
    assert one == sorted([
        ("1", 'a "b", c', 2, None), ("2", "x", 3, "2,x,3,4,5,6"), ("3", "y", None, "3,y"), ("1", None, None, "1,,n/a"),
        next(r for r in one if r[3] == '7,"open,8'),
    ], key=repr)
    _file(tmp_path, "b", "y.csv", "\n  \nqty,\"PLU, Number\"\n5,9\n")
    both = _read(spark, tmp_path)
    assert sorted(both, key=repr) == sorted([*one, ("9", None, 5, None)], key=repr)


def test_blank_first_lines_in_one_layout(spark, tmp_path):
    _file(tmp_path, "a", "x.csv", '\n\n"PLU, Number",Descriptor,Qty\n1,a,2\n')
    assert _read(spark, tmp_path) == [("1", "a", 2, None)]


def test_fail_mode_fails_on_bad_rows(spark, tmp_path):
    _file(tmp_path, "a", "x.csv", LINES)
    with pytest.raises(Exception, match="does not fit its header"):
        _read(spark, tmp_path, "fail")
    with pytest.raises(Exception, match="does not fit its header"):
        pos_files.read_csv_tree(spark, str(tmp_path), ["descriptor"], on_error="fail").select("descriptor").collect()


def test_equal_names_are_numbered(spark, tmp_path):
    _file(tmp_path, "a", "x.csv", "A,A,B,a\n1,2,3,4\n")
    df = pos_files.read_csv_tree(spark, str(tmp_path))
    assert [(r.a, r.a_2, r.a_3, r.b) for r in df.collect()] == [("1", "2", "4", "3")]


def test_unnamed_files_are_rejects(spark, tmp_path):
    drop, target = tmp_path / "drop", str(tmp_path / "t")
    text = "PLU Number,Total Qty-Sales,Total Sales\n1,{},0\n"
    _file(drop, "SRP_202408", "SRP_1216_20240801.csv", text.format(1))
    _file(drop, "SRP_202408", "notes.csv", text.format(2))
    for latest in (False, True):
        rejects = pos_ingest.ingest(spark, str(drop), target, COLUMNS, NUMERIC, latest_only=latest).collect()
        assert [(r._path.rsplit("/", 1)[1], r.rows_read, r.rows_rejected) for r in rejects] == [("notes.csv", 1, 1)]
        assert versions.read(spark, target).count() == 1


def test_ingest_replaces_whole_locations_or_single_days(spark, tmp_path):
    text = "PLU Number,Total Qty-Sales,Total Sales\n1,{},0\n"
    first, second, target = tmp_path / "1", tmp_path / "2", str(tmp_path / "t")
    for name in ("SRP_1216_20240801.csv", "SRP_1216_20240802.csv", "SRP_1217_20240801.csv"):
        _file(first, "SRP_202408", name, text.format(1))
    _file(second, "SRP_202408", "SRP_1216_20240802.csv", text.format(5))
    days = lambda: sorted((str(r.location), str(r.date), int(r.total_qty_sales)) for r in versions.read(spark, target).collect())
    pos_ingest.ingest(spark, str(first), target, COLUMNS, NUMERIC)
    pos_ingest.ingest(spark, str(second), target, COLUMNS, NUMERIC, whole_locations=False)
    assert days() == [("1216", "2024-08-01", 1), ("1216", "2024-08-02", 5), ("1217", "2024-08-01", 1)]
    pos_ingest.ingest(spark, str(second), target, COLUMNS, NUMERIC)
    assert days() == [("1216", "2024-08-02", 5), ("1217", "2024-08-01", 1)]


def test_backfill_empties_a_day_whose_file_has_no_rows(spark, tmp_path):
    drop, target = tmp_path / "drop", str(tmp_path / "t")
    text = "PLU Number,Total Qty-Sales,Total Sales\n"
    path = _file(drop, "SRP_202408", "SRP_1216_20240801.csv", text + "1,2,3\n")
    _file(drop, "SRP_202408", "SRP_1217_20240801.csv", text + "1,2,3\n")
    pos_ingest.ingest(spark, str(drop), target, COLUMNS, NUMERIC)
    with open(path, "w") as f:
        f.write(text)
    asked = spark.createDataFrame([(date(2024, 8, 1), "1216")], "date date, location string")
    status = pos_ingest.backfill(spark, str(drop), target, asked, COLUMNS, NUMERIC, "total_qty_sales").collect()
    assert [r.status for r in status] == ["Verification failed"]
    assert [str(r.location) for r in versions.read(spark, target).collect()] == ["1217"]


def test_a_hundred_thousand_small_files(spark, tmp_path):
    """All are listed, two versions of each name stand against each other, and no path or row passes the driver on the way."""
    (tmp_path / "one").write_text("PLU Number,Total Qty-Sales,Total Sales\n1,2,3\n")
    (tmp_path / "two").write_text("PLU Number,Total Qty-Sales,Total Sales\n1,5,3\n")
    os.utime(tmp_path / "one", (1_600_000_000, 1_600_000_000))
    for k in range(100):
        for version in ("one", "two"):
            folder = tmp_path / "drop" / version / f"SRP_2024{k % 12 + 1:02d}" / f"part{k}"
            folder.mkdir(parents=True)
            for n in range(500):
                os.link(tmp_path / version, folder / f"SRP_{k * 500 + n}_20240801.csv")
    files = pos_files.drop_files(spark, str(tmp_path / "drop"))
    assert files.count() == 100_000
    latest = pos_files.latest_files(files)
    assert latest.count() == 50_000 and latest.filter("file_path LIKE '%/one/%'").isEmpty()
    few = latest.filter("name LIKE 'SRP_1234%'")
    rows = pos_files.read_csv_tree(spark, str(tmp_path / "drop"), COLUMNS, NUMERIC, files=few)
    assert rows.agg({"total_qty_sales": "sum"}).first()[0] == 5 * few.count()


def test_path_tables_read_what_the_reader_reads(spark, tmp_path, monkeypatch):
    """In ranges of a few bytes, with quotes, blank lines, a byte order mark, foreign line ends and files without rows."""
    texts = [LINES, "﻿" + LINES, "\n \n" + LINES.replace("\n", "\r\n"), '"PLU, Number",Descriptor,Qty\n', "", '"PLU, Number",Descriptor,Qty\n9,last,"1,000"', LINES + "é,ü,4\n" * 50]
    for k, text in enumerate(texts):
        path = tmp_path / f"SRP_{k}_20240801.csv"
        path.write_bytes(text.encode())
    read = lambda files: sorted((tuple(r) for r in pos_files.read_csv_tree(
        spark, str(tmp_path), ["plu,_number", "descriptor", "qty"], ["qty"], files=files).drop("_modified").collect()), key=repr)
    want = read(None)
    for size in (1, 7, 64, 1 << 20):
        monkeypatch.setattr(pos_files, "RANGE_BYTES", size)
        assert read(pos_files.drop_files(spark, str(tmp_path))) == want

    class Closed:
        @staticmethod
        def from_uri(uri):
            raise OSError(uri)

    monkeypatch.setattr(pos_files, "FileSystem", Closed)
    assert read(pos_files.drop_files(spark, str(tmp_path)).filter("file_path LIKE '%SRP_6%'")) == [r for r in want if "SRP_6" in str(r)]
