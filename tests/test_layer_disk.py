"""What a written layer leaves on the disks."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from mercato.sources import tables
from mercato.sources.tables import LayerStore


def shuffle_files(spark):
    found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getPath() for i in range(found.size())} if found.size() else set()


def days(spark):
    rows = spark.range(3000).select((F.col("id") % 700).alias("k"), F.expr("date_add(DATE '2026-01-01', int(id % 400))").alias("d"))
    return rows.groupBy("k", "d").agg(F.count("*").alias("n"))


def left_after(spark, before):
    """Shuffle files that are there and were not before; they are deleted in the background."""
    for _ in range(50):
        left = {f for f in shuffle_files(spark) - before if "/shuffle_" in f}
        if not left:
            break
        time.sleep(0.1)
    return left


@pytest.mark.parametrize("options", [{}, {"by_date": "d"}, {"by_date": "d", "in_two": True}])
def test_shuffles_go_with_the_write(spark, tmp_path, options):
    """the tables of a run do not pile up their shuffles."""
    before, setting = shuffle_files(spark), spark.conf.get(tables._DROP_SHUFFLES, None)
    store = LayerStore(spark, str(tmp_path), "r", period="month")
    back = store.write(days(spark), "gold", "t", **options)
    assert not left_after(spark, before)
    assert spark.conf.get(tables._DROP_SHUFFLES, None) == setting
    back = back.select("k", "d", "n")
    assert back.exceptAll(days(spark)).count() == 0 and back.count() == days(spark).count()


def test_rows_written_in_two_steps_stand_once(spark, tmp_path):
    """the copy before the rows are dealt by folder is deleted, and the layout is that of one step."""
    store = LayerStore(spark, str(tmp_path), "r", period="month")
    store.write(days(spark), "gold", "t", "d", in_two=True)
    folders = {p.name for p in Path(store.path("gold", "t")).iterdir() if p.is_dir()}
    assert folders == {f"_folder={y}-{m:02d}-01" for y, m in [(2026, m) for m in range(1, 13)] + [(2027, 1), (2027, 2)]}
    assert not Path(store.path("gold_unsorted", "t")).exists()


def test_the_last_of_writes_side_by_side_puts_the_setting_back(spark):
    before = spark.conf.get(tables._DROP_SHUFFLES, None)
    first, second = tables._shuffles_dropped(spark), tables._shuffles_dropped(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(tables._DROP_SHUFFLES) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(tables._DROP_SHUFFLES, None) == before
