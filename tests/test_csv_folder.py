"""Folders whose files have different headers."""

import datetime as dt

import pytest

from mixlab.config import MixConfig
from mixlab.sources import files, loaders

SALES = "date DATE, revenue DOUBLE"


def _put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


def test_columns_are_found_by_name_in_every_file(spark, tmp_path):
    path = tmp_path / "sales"
    _put(path, "a.csv", "date,revenue\n2010-12-01,1.5\n2010-12-02,\n")
    _put(path, "b.csv", 'note,revenue,date\n"x, y",2.5,12/3/2010 8:26\n\nrevenue due,oops,2010-12-04\n')
    _put(path, "c.csv", "﻿date\n2010-12-05\n")
    _put(path, "d.csv", '"date", "revenue" ,"extra"\n2010-12-06\ndate,revenue,extra\n')
    got = files.scan_csv_folder(spark, str(path), SALES)
    assert got.dtypes == [("date", "date"), ("revenue", "double"), ("extra", "string"), ("note", "string")]
    rows = sorted((str(r["date"]), r["revenue"], r["note"], r["extra"]) for r in got.collect())
    assert rows == [
        ("2010-12-01", 1.5, None, None),
        ("2010-12-02", None, None, None),
        ("2010-12-03", 2.5, 'x, y', None),
        ("2010-12-04", None, "revenue due", None),
        ("2010-12-05", None, None, None),
        ("2010-12-06", None, None, None),
        ("None", None, None, "extra"),
    ]


def test_what_no_file_has_and_files_without_header_are_refused(spark, tmp_path):
    _put(tmp_path / "one", "a.csv", "date,sales\n2010-12-01,1\n")
    with pytest.raises(ValueError, match="revenue"):
        files.scan_csv_folder(spark, str(tmp_path / "one"), SALES)
    _put(tmp_path / "two", "a.csv", "date,revenue\n2010-12-01,1\n")
    _put(tmp_path / "two", "b.csv", "2010-12-02,2\n")
    with pytest.raises(Exception, match="no header in"):
        files.scan_csv_folder(spark, str(tmp_path / "two"), SALES).collect()


def test_headers_alone_are_no_rows(spark, tmp_path):
    _put(tmp_path / "s", "a.csv", "date,revenue\n")
    _put(tmp_path / "s", "b.csv", "revenue,date,revenue\n")
    assert files.scan_csv_folder(spark, str(tmp_path / "s"), SALES).count() == 0


def test_loaders_read_such_folders(spark, tmp_path):
    _put(tmp_path / "s", "a.csv", "date,channel,spend\n2010-12-01,tv,5\n2011-01-01,tv,6\n")
    _put(tmp_path / "s", "b.csv", "spend,date,channel\n7,12/2/2010,web\n")
    config = MixConfig(start_date="2010-12-01", end_date="2010-12-31")
    rows = loaders.load_marketing(spark, str(tmp_path / "s"), config, scan=files.scan_csv_folder).collect()
    assert {tuple(r) for r in rows} == {(dt.date(2010, 12, 1), "tv", 5.0), (dt.date(2010, 12, 2), "web", 7.0)}


def test_lines_are_parsed_once_each(spark, tmp_path):
    _put(tmp_path / "s", "a.csv", "date,revenue,a,b,c\n2010-12-01,1,2,3,4\n")
    plan = files.scan_csv_folder(spark, str(tmp_path / "s"), SALES)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv") == 1
