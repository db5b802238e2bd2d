"""Files: unreadable records are counted and audited, and only the files that a range needs are opened."""

import json

import pytest
from pyspark.sql import functions as F

from infield.operators import gold
from infield.plans import dashboard as db
from infield.sources import lake


def audit(spark, root):
    return sorted((r.status, r.rows, r.bad_rows, r.bad_files, r.days) for r in lake.read(spark, root, "audit_run").collect())


def test_two_bad_files_are_counted_by_the_write(spark, tmp_path):
    root, raw = str(tmp_path), tmp_path / "raw"
    raw.mkdir()
    for i in range(6):
        (raw / f"f{i}.json").write_text(json.dumps([{"k": i, "dt": f"2026-05-0{1 + i % 3}"}, {"k": 10 + i, "dt": "2026-05-01"}]))
    (raw / "one.json").write_text(json.dumps({"k": 99, "dt": "2026-05-02"}))
    (raw / "bad1.json").write_text('{"k": 1, "dt"')
    (raw / "bad2.json").write_text("no json at all")
    lake.write_days(spark.createDataFrame([("2026-05-04", 7), ("2026-05-09", 8)], "dt string, k long"), root, "t", ["2026-05-04", "2026-05-09"])
    records = lake.json_records(spark, str(raw), "k long, dt string")
    told = lake.counted_write(records, root, "t", [f"2026-05-0{i}" for i in range(1, 6)], "ingest")
    assert (told["rows"], told["bad_rows"], told["bad_files"], told["days"], told["status"]) == (13, 2, 2, 3, "partial")
    assert sorted(r.k for r in lake.read(spark, root, "t").collect()) == sorted([*range(6), *range(10, 16), 99, 8])  # the fourth is emptied, the ninth isn't covered
    assert audit(spark, root) == [("partial", 13, 2, 2, 3)]
    assert len(lake.readable(records).collect()) == 13


def test_every_run_is_audited_even_one_that_fails(spark, tmp_path):
    root = str(tmp_path)
    good = spark.createDataFrame([("2026-05-01", "1"), ("2026-05-02", "2")], "dt string, k string")
    assert lake.counted_write(good, root, "t", ["2026-05-01"], "silver", lambda df: df.withColumn("k", F.col("k").cast("long")))["rows"] == 1
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        lake.counted_write(good.withColumn("k", F.lit("x")), root, "t", ["2026-05-01"], "silver", lambda df: df.withColumn("k", F.col("k").cast("long")))
    assert lake.counted_write(good.limit(0), root, "t", ["2026-05-01"], "silver")["days"] == 0
    assert [a[0] for a in audit(spark, root)] == ["failed", "ok", "ok"]


def test_only_files_of_the_range_are_opened(spark, tmp_path):
    for year in range(2019, 2024):
        day = f"{year}0601" if year % 2 else f"{year}-06-01"
        (tmp_path / f"{year}plays.csv").write_text(f"id,date\n{year},{day}\n{year + 5000},{year}-12-31 10:00\n")
    (tmp_path / "all.csv").write_text("id,date\n1,2021-06-01\n2,junk\n")
    (tmp_path / "readme.txt").write_text("no csv")
    files = lake.listing(spark, str(tmp_path))
    assert {(r.path.rsplit("/", 1)[1], r.season) for r in files.collect()} == {*((f"{y}plays.csv", y) for y in range(2019, 2024)), ("all.csv", None)} and files.where("size > 10").count() == 6
    df = lake.csv_range(spark, str(tmp_path), "id long, date string", "date", "2020-12-01", "2021-07-01")
    assert sorted(r.id for r in df.collect()) == [1, 2021, 7020]
    assert {f.rsplit("/", 1)[1] for f in df.inputFiles()} == {"2020plays.csv", "2021plays.csv", "all.csv"}
    assert lake.csv_range(spark, str(tmp_path), "id long, date string", None, "2023-01-01", "2023-01-01", "20*.csv").count() == 2
    assert lake.csv_range(spark, str(tmp_path), "id long, date string", "date", "1990-01-01", "1990-01-02", "20*.csv") is None
    with pytest.raises(Exception, match="(?i)header|column"):
        lake.csv_range(spark, str(tmp_path), "date string, id long", "date", "2021-01-01", "2021-12-31").collect()


def test_days_in_three_spellings(spark):
    rows = [("2021-06-01",), ("20210601",), ("2021-06-01T12:00:00Z",), (" 2021-06-01",), ("June",), ("",), (None,), ("202106",)]
    assert [r.d for r in spark.createDataFrame(rows, "c string").select(lake.iso_day("c").alias("d")).collect()] == ["2021-06-01"] * 4 + [None] * 4


def test_levels_from_one_scan(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", None, 2), ("b", "x", 4)], "p string, q string, v int")
    out = db.leveled(df, {"both": ["p", "q"], "q": ["q"], "all": []}, [F.sum("v").alias("v")])
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([("both", "a", "x", 1), ("both", "a", None, 2), ("both", "b", "x", 4), ("q", None, "x", 5), ("q", None, None, 2), ("all", None, None, 7)], key=repr)
    with pytest.raises(ValueError):
        db.leveled(df, {"one": ["p"], "two": ["p"]}, [F.count("*")])


def test_who_is_first_does_not_depend_on_partitions(spark):
    rows = [("2026-05-01", "7", "Zed", "t1"), ("2026-05-01", "7", "Ann", "t2"), ("2026-05-01", "8", None, None), ("2026-05-01", "8", "Bo", "t1")]
    found = set()
    for n in (1, 3, 7):
        rosters = spark.createDataFrame(rows[::-1] if n == 3 else rows, "dt string, player_id string, player_name string, team_id string").repartition(n)
        bios = spark.createDataFrame([("2026-05-01", "7", "Aaa", "1990-01-01")], "dt string, player_id string, player_name string, dob string")
        records = gold.collected({("mlb_statsapi", "player_bios"): bios, ("mlb_statsapi", "rosters"): rosters})
        first = records.groupBy("source_id").agg(F.min_by(F.coalesce("name", F.lit("-")), "nth").alias("name"))
        found.add(tuple(sorted(map(tuple, first.collect()))))
    assert found == {(("7", "Ann"), ("8", "Bo"))}  # rosters before bios, then by content
