"""Raw input loses nothing: names, columns, layouts, numbers."""

import json

import pytest
from pyspark.sql import functions as F

from mercato.functions.clean import json_friendly, plain_day
from mercato.operators import checks
from mercato.plans import questions
from mercato.schemas import SOURCES
from mercato.sources import raw


def records(spark, path, name):
    rows = raw.raw_records(spark, str(path), SOURCES[name]).collect()
    return sorted((r["file_name"], r["row_number"], r["raw"]) for r in rows)


def test_csv_is_read_by_name_with_all_columns(spark, tmp_path):
    folder = tmp_path / "spend.csv"
    folder.mkdir()
    (folder / "a.csv").write_text('channel,note,campaign_id,spend_date,spend_amount\nWEB,"two\nlines, ""quoted""",k,2026-07-01,10\nAPP,,k2,2026-07-02,3\n')
    (folder / "b.csv").write_text("spend_date,campaign_id,channel,spend_amount\n2026-07-03,k3,WEB,7.5\n")
    got = [(f, n, json.loads(x)) for f, n, x in records(spark, folder, "campaign_spend")]
    assert got == [
        ("a.csv", 0, dict(channel="WEB", note='two\nlines, "quoted"', campaign_id="k", spend_date="2026-07-01", spend_amount="10")),
        ("a.csv", 1, dict(channel="APP", campaign_id="k2", spend_date="2026-07-02", spend_amount="3")),
        ("b.csv", 0, dict(channel="WEB", campaign_id="k3", spend_date="2026-07-03", spend_amount="7.5"))]
    typed = raw.scan_csv(spark, str(folder), "campaign_id string, spend_amount decimal(14,2), absent string").orderBy("campaign_id").collect()
    assert [(r["campaign_id"], str(r["spend_amount"]), r["absent"]) for r in typed] == [("k", "10.00", None), ("k2", "3.00", None), ("k3", "7.50", None)]


def test_each_json_file_has_its_own_layout(spark, tmp_path):
    (tmp_path / "lines.json").write_text("".join(f'{{"order_id": "l{i}"}}\n' + ("\n" if i == 3 else "") for i in range(40)))
    (tmp_path / "array.json").write_text('\n [{"order_id": "a0"}, {"order_id": "a1"}]')
    got = records(spark, tmp_path, "orders")
    assert [(f, n, json.loads(x)["order_id"]) for f, n, x in got if f == "array.json"] == [("array.json", 0, "a0"), ("array.json", 1, "a1")]
    assert [(n, json.loads(x)["order_id"]) for f, n, x in got if f == "lines.json"] == [(i + (i > 3), f"l{i}") for i in range(40)]


def test_line_numbers_run_over_split_files(spark, tmp_path):
    text = "".join(json.dumps({"order_id": i, "pad": "x" * (i % 50)}) + "\n" for i in range(2000))
    (tmp_path / "big.json").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        rows = raw.line_records(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r["row_number"], json.loads(r["raw"])["order_id"]) for r in rows) == [(i, i) for i in range(2000)]


@pytest.mark.parametrize("zone", ["Asia/Jakarta", "America/New_York", "UTC"])
def test_plain_dates_never_shift(spark, zone):
    texts = ["2026-06-22", " 2026/06/22", "22-06-2026", "20260622", "nonsense", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(plain_day("t", zone)).collect()]
    assert [str(x) for x in got] == ["2026-06-22"] * 4 + ["None"] * 2
    late = spark.createDataFrame([("2026-06-22 23:30:00",)], "t string").select(plain_day("t", zone)).first()[0]
    assert str(late) == {"Asia/Jakarta": "2026-06-22", "America/New_York": "2026-06-23", "UTC": "2026-06-22"}[zone]


def test_times_keep_fraction_and_offset(spark):
    df = spark.sql("SELECT timestamp '2026-07-01 01:02:03.25' AS a, timestamp '2026-07-01 01:02:03' AS b, timestamp_ntz '2026-07-01 01:02:03.000001' AS c, date '2026-07-01' AS d")
    assert tuple(df.select(*json_friendly(df.schema)).first()) == ("2026-07-01T01:02:03.250000+00:00", "2026-07-01T01:02:03+00:00", "2026-07-01T01:02:03.000001", "2026-07-01")


@pytest.mark.parametrize("rows", [0, -1, 1001, 5000])
def test_a_cap_out_of_range_is_refused(spark, rows):
    with pytest.raises(ValueError, match="between 1 and 1000"):
        questions.capped(spark.range(3), rows)
    assert questions.capped(spark.range(3), 2).count() == 2


def test_spread_of_large_close_values(spark):
    df = spark.range(1000).select((F.lit("99999999.00").cast("decimal(14,2)") + (F.col("id") % 2) * F.lit("0.01").cast("decimal(3,2)")).alias("x"))
    assert checks.exact_profile(df, ["x"]).first()["stddev"] == pytest.approx(0.0050025, rel=1e-4)
