"""The page index opens only the pages that can hold wanted rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from metropulse.sources import pages, readers
from metropulse.operators.staging import shared_folder

SCHEMA = "id BIGINT, at STRING"


def land(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps([{"id": i, "at": t} for i, t in rows]))


@pytest.fixture
def landed(spark, tmp_path):
    folder = tmp_path / "pages"
    for month in range(1, 13):
        for day in (1, 7, 8, 20):
            stamps = [(1000 * month + 10 * day + h, f"2023-{month:02d}-{day:02d}T{h:02d}:30:00") for h in (0, 23)]
            land(folder, f"page-{(month * 7 + day) % 97:03d}-{month}-{day}.json", [*stamps, (0, "unreadable"), (1, None)])
    land(folder, "odd.json", [(5, "x")])
    land(folder, "none.json", [])
    return folder, shared_folder(spark, "page-index")


def test_only_pages_of_the_wanted_days_are_opened(spark, landed):
    folder, index = landed
    assert pages.update_index(spark, str(folder), index, SCHEMA, "at") == 50
    assert pages.update_index(spark, str(folder), index, SCHEMA, "at") == 0
    spans = pages.first_weeks(2023)
    got = pages.read_pages(spark, index, SCHEMA, "at", spans)
    whole = readers.sample_first_week(readers.read_json_pages(spark, str(folder), SCHEMA), "at", 2023)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect())) and got.count() == 48
    assert len(got.inputFiles()) == 24 and len(whole.inputFiles()) == 50
    nothing = pages.read_pages(spark, index, SCHEMA, "at", [(dt.datetime(2030, 1, 1), dt.datetime(2031, 1, 1))])
    assert nothing.count() == 0 and nothing.columns == ["id", "at"]


def test_new_and_changed_pages_are_entered(spark, landed):
    folder, index = landed
    pages.update_index(spark, str(folder), index, SCHEMA, "at")
    land(folder, "late.json", [(77, "2023-05-03T10:00:00")])
    land(folder, "odd.json", [(78, "2023-05-04T10:00:00"), (79, "2023-06-04T10:00:00")])
    assert pages.update_index(spark, str(folder), index, SCHEMA, "at") == 2
    assert pages.read_index(spark, index).count() == 51
    may = [(dt.datetime(2023, 5, 2), dt.datetime(2023, 5, 6))]
    got = pages.read_pages(spark, index, SCHEMA, "at", may)
    assert sorted(r.id for r in got.collect()) == [77, 78]
    rows = pages.read_index(spark, index).where(F.col("page").endswith("odd.json")).first().rows
    assert rows == 2


def test_first_weeks_end_with_their_month():
    spans = pages.first_weeks(2023, 40)
    assert spans[1] == (dt.datetime(2023, 2, 1), dt.datetime(2023, 3, 1)) and len(spans) == 12
    assert pages.first_weeks(2024)[0] == (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 8))


def test_numbers_read_as_text_are_not_fetched_again(spark, tmp_path):
    """A page is read once, however many numbers its text columns take, and every text is as it was written."""
    numbers = ["7", "1.50", "12345678901234567890.125", "1E5", "-0.0"]
    cells = ",\n".join(f'{{"a": {n}, "b": {i}, "c": "é"}}' for i, n in enumerate(numbers * 400))
    (tmp_path / "many.json").write_text(f"[{cells}]\n")
    (tmp_path / "single.json").write_text('\ufeff{\n"a": "lone",\n"c": 5}', encoding="utf-8")
    (tmp_path / "broken.json").write_text('[{"a": 1}, {"a": 2')
    (tmp_path / "dirty.json").write_text('[{"a": {"k": 1.0}, "b": "x"}, {"a": [1, 2.50], "b": 3}]')
    (tmp_path / "void.json").write_text("")
    (tmp_path / "blank.json").write_text(" \n\n")
    (tmp_path / "none.json").write_text("[]")
    size = sum(f.stat().st_size for f in tmp_path.glob("*.json"))

    def bytes_read():
        return sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())

    before = bytes_read()
    got = readers.read_json_pages(spark, str(tmp_path), "a STRING, b BIGINT, c STRING").collect()
    assert bytes_read() - before < 4 * size
    want = [(n, i, "é") for i, n in enumerate(numbers * 400)]
    want += [("lone", None, "5"), (None, None, None), ('{"k": 1.0}', None, None), ("[1, 2.50]", 3, None)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
