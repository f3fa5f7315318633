"""Files of the file destination roll by bytes: numbering against one line at a time, limits, repeats, compaction."""

import datetime as dt
import pathlib

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.schema import FILE
from sluice.streaming import compaction, sinks

MEGABYTE = sinks.MEGABYTE


def one_by_one(sizes, limit, number=0, filled=0):
    numbers = []
    for size in sizes:
        if filled and filled + size > limit:
            number, filled = number + 1, 0
        numbers.append(number)
        filled += size
    return numbers, number, filled


@given(st.lists(st.integers(1, 40), max_size=60), st.integers(1, 50), st.integers(0, 60))
def test_numbers_equal_one_line_at_a_time(sizes, limit, cut):
    wanted = one_by_one(sizes, limit)
    first, number, filled = sinks.file_numbers(np.array(sizes[:cut], np.int64), 0, 0, limit)
    rest, number, filled = sinks.file_numbers(np.array(sizes[cut:], np.int64), number, filled, limit)
    assert ([*first, *rest], number, filled) == wanted


def table(spark, lengths, logs=1, days=1):
    rows = [(f"log{i % logs}", dt.date(2024, 1, 1 + i % days), f"{i:06d}" + "é" * n) for i, n in enumerate(lengths)]
    return spark.createDataFrame(rows, "log string, cluster_date date, value string")


def write(rows, tmp_path, limit, batch_id=0):
    options = sinks.SinkOptions(str(tmp_path), max_megabytes=limit and limit / MEGABYTE)
    sinks.SINKS[FILE].write(rows, options, "r", batch_id)
    return options.path(FILE)


def files(path):
    return [p.read_text().splitlines() for p in pathlib.Path(path).rglob("part-*.txt")]


def test_no_file_is_above_the_limit(spark, tmp_path):
    lengths = [(i * 37) % 90 for i in range(4000)]
    rows = table(spark, lengths, logs=3, days=2).repartition(4, F.col("value"))
    path = write(rows, tmp_path, 2000)
    found = files(path)
    sizes = [sum(len(line.encode()) + 1 for line in lines) for lines in found]
    assert max(sizes) <= 2000
    assert sorted(line for lines in found for line in lines) == sorted(r["value"] for r in rows.collect())
    # Every task leaves one open file a log and day; the others are full but for a line.
    total, longest = sum(sizes), 6 + 2 * 89 + 1
    assert len(sizes) <= total / (2000 - longest) + 4 * 3 * 2
    kept = spark.read.text(path)
    assert kept.select("log", "cluster_date").distinct().count() == 6


def test_long_lines_stand_alone(spark, tmp_path):
    rows = table(spark, [5, 3000, 5, 5, 3000, 3000, 0]).coalesce(1)
    sizes = sorted(sum(len(line.encode()) + 1 for line in lines) for lines in files(write(rows, tmp_path, 100)))
    # 17 + 17 bytes fit into one file; the three long lines have one each, and so have the first line and the last.
    assert sizes == [7, 17, 34, 6007, 6007, 6007]


def test_lines_are_scanned_once_and_not_exchanged(spark):
    plan = sinks.rolled(spark.range(100).selectExpr("'a' AS log", "current_date() AS cluster_date", "string(id) AS value"), 50)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and text.count("Range") == 1


@pytest.mark.parametrize("second", [50, None])
def test_repeats_and_other_limits_leave_one_copy(spark, tmp_path, second):
    rows = table(spark, [10] * 40).coalesce(1)
    path = write(rows, tmp_path, 50)
    sinks.remove(spark, f"{path}/*/*/{sinks.batch_folder('r', 0)}")
    write(rows, tmp_path, second)
    write(rows.limit(3), tmp_path, None, batch_id=1)
    assert spark.read.text(path).where("batch_id = 0").count() == 40 and spark.read.text(path).count() == 43


def test_compaction_reads_rolled_files(spark, tmp_path):
    for n in range(3):
        path = write(table(spark, [10] * 40, days=2), tmp_path, 100, batch_id=n)
    columns, target = sinks.STORED[FILE]
    stored = compaction.Table(path, columns, target, compaction.TEXT)
    before = sorted(r["value"] for r in compaction.read(spark, stored).collect())
    assert len(compaction.compact(spark, stored, dt.date(2024, 1, 2), least=2)) == 1
    assert sorted(r["value"] for r in compaction.read(spark, stored).collect()) == before and len(before) == 120


def test_no_lines_no_files(spark, tmp_path):
    assert files(write(table(spark, [1]).where("false"), tmp_path, 100)) == []


def test_small_files_of_a_day_share_one_folder(spark, tmp_path):
    path = write(table(spark, [(i * 37) % 90 for i in range(2000)], days=2).repartition(3), tmp_path, 300)
    found = list(pathlib.Path(path).rglob("part-*.txt"))
    assert len(found) > 300 and len({p.parent for p in found}) == 2
    assert spark.read.text(path).count() == 2000


def test_files_above_a_row_roll_by_number(spark, tmp_path, monkeypatch):
    rows = table(spark, [(i * 37) % 90 for i in range(2000)]).coalesce(1)
    small = sorted(map(tuple, files(write(rows, tmp_path / "small", 900))))
    monkeypatch.setattr(sinks, "WHOLE_FILE", 0)
    assert sorted(map(tuple, files(write(rows, tmp_path / "large", 900)))) == small
