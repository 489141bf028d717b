"""Log files chosen by name, tables of an embedded database, and results that take their place together or not at all."""

import datetime

import pytest
from pyspark.sql import functions as F

from lectern.sources import database as D
from lectern.sources import logs, results, sinks


def test_only_selected_files_are_opened(spark, tmp_path):
    for name, text in {"tracking.log-20240105": "a\nb\n", "deep/tracking.log-2024-01-06.log": "c\n", "t.1704585600.log": "d\n", "other-20240106.tmp": "e\n"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    (tmp_path / "tracking.log-20240301.gz").write_bytes(b"no gzip at all")  # reading it would end the job
    (tmp_path / "empty-20240105").write_text("")
    lines = logs.read_log_files(spark, [str(tmp_path)], "2024-01-06", "2024-01-07", expand=1)
    assert sorted(r.value for r in lines.collect()) == ["a", "b", "c", "d", "e"]
    tracking = (r".*/tracking\.log-(?P<date>\d{8})$", r".*/t\.(?P<timestamp>\d+)\.log", r".*/other.*")
    lines = logs.read_log_files(spark, [str(tmp_path)], "2024-01-06", "2024-01-07", tracking, expand=0)
    assert sorted(r.value for r in lines.collect()) == ["e"]
    assert sorted(r.value for r in logs.read_log_files(spark, [str(tmp_path)], "2024-01-07", "2024-01-08", tracking, 2, "yyyyMMdd").collect()) == ["a", "b", "d", "e"]
    listed = logs.list_files(spark, [str(tmp_path)], ("tracking*", "deep/*"))
    assert sorted(r.path.rpartition("/")[2] for r in listed.collect()) == ["tracking.log-2024-01-06.log", "tracking.log-20240105", "tracking.log-20240301.gz"]
    assert logs.list_files(spark, [str(tmp_path)], ("empty*",)).count() == 0
    assert [r.path for r in logs.select_log_files(listed, "2024-03-01", "2024-03-02", expand=0).collect()][0].endswith("20240301.gz")


@pytest.fixture(scope="module")
def url(spark, tmp_path_factory):
    return f"jdbc:derby:{tmp_path_factory.mktemp('derby') / 'db'};create=true"


def test_tables_in_ranges_and_dated_partitions(spark, url, tmp_path):
    rows = [(i, f"n{i}" if i % 3 else None, float(i) if i % 4 else None) for i in range(1, 101)]
    spark.createDataFrame(rows, "id int, name string, score double").write.jdbc(url, "people")
    all_rows = D.read_table(spark, url, "people", split='"id"', parts=4)
    assert all_rows.rdd.getNumPartitions() == 4 and sorted(map(tuple, all_rows.collect())) == rows
    some = D.read_table(spark, url, "people", ['"id"', '"name"'], '"id" > 90', '"id"', 3)
    assert sorted(map(tuple, some.collect())) == [r[:2] for r in rows if r[0] > 90]
    assert D.read_table(spark, url, "people", where='"id" < 0', split='"id"').count() == 0
    path = str(tmp_path / "people")
    D.import_table(spark, url, "people", path, "2024-01-01", where='"id" <= 5')
    D.import_table(spark, url, "people", path, "2024-01-02", where='"id" <= 7')
    back = D.import_table(spark, url, "people", path, "2024-01-01", where='"id" <= 3')
    assert sorted(r.id for r in back.collect()) == [1, 2, 3] and spark.read.parquet(path).count() == 10 and back.first().dt == datetime.date(2024, 1, 1)
    D.dump_query(spark, url, "SELECT \"id\", \"name\", TIMESTAMP('2024-01-02 03:04:05') AS t, DATE('2024-01-02') AS d FROM people WHERE \"id\" < 4", str(tmp_path / "dump"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "dump")).collect()) == [f"{i}\t{n}\t2024-01-02T03:04:05.000000\t2024-01-02" for i, n in ((1, "n1"), (2, "n2"), (3, "-"))]


def execute(spark, url, *statements):
    with D.transaction(spark, url) as statement:
        for s in statements:
            statement.executeUpdate(s)


def test_replaced_tables(spark, url):
    execute(spark, url, "CREATE TABLE report (course VARCHAR(20) NOT NULL, n INT)", "INSERT INTO report VALUES ('old', 1)")
    read = lambda: sorted(map(tuple, spark.read.jdbc(url, "report").collect()))
    frame = lambda *rows: spark.createDataFrame(rows, "course string, n int")
    D.replace_table(frame(("a", 1), ("b", None), ("c", 3)), url, "report", key=["course"])
    assert read() == [("a", 1), ("b", None), ("c", 3)]
    with pytest.raises(ValueError):
        D.replace_table(frame().limit(0), url, "report")
    with pytest.raises(ValueError):
        D.replace_table(frame(("x", 1), ("x", 2)), url, "report", key=["course"])
    with pytest.raises(Exception):  # noqa: B017 - the database refuses a null, after the old rows were deleted
        D.replace_table(frame(("x", 1), (None, 2)), url, "report")
    with pytest.raises(Exception):  # noqa: B017 - a row fails while the new ones are written
        D.replace_table(frame(("x", 1), ("y", 2)).withColumn("n", F.when(F.col("course") == "y", F.raise_error(F.lit("broken")).cast("int")).otherwise(1)), url, "report")
    assert read() == [("a", 1), ("b", None), ("c", 3)]
    D.replace_table(frame().limit(0), url, "report", allow_empty=True)
    assert read() == []
    left = D.read_table(spark, url, "sys.systables", ["tablename"], "tabletype = 'T'").collect()
    assert not [r for r in left if r[0].upper().startswith("REPORT_")]


def test_results_take_their_place_together(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "results")
    daily = lambda n: spark.createDataFrame([("c", f"2024-01-0{i}", i, n) for i in range(1, 4)], "course_id string, date string, count int, cumulative_count int")
    activity = lambda n: spark.createDataFrame([("c", "2024-01-01", "2024-01-08", "ACTIVE", n)], "course_id string, interval_start string, interval_end string, label string, count int")
    counts = lambda: (results.read_result(spark, root, "course_enrollment_daily").first().cumulative_count, results.read_result(spark, root, "course_activity").first()["count"])
    results.publish({"course_enrollment_daily": daily(1), "course_activity": activity(1)}, root)
    results.publish({"course_enrollment_daily": daily(2).withColumn("more", F.lit(1)), "course_activity": activity(2)}, root)
    assert counts() == (2, 2) and results.read_result(spark, root, "course_enrollment_daily").columns == ["course_id", "date", "count", "cumulative_count"]
    for bad in ({"course_activity": activity(3).unionByName(activity(3))}, {"course_activity": activity(3).limit(0)}, {"course_activity": activity(3).drop("label")}, {"none": activity(3)}):
        with pytest.raises(ValueError):
            results.publish({"course_enrollment_daily": daily(3)} | bad, root)
    assert counts() == (2, 2)
    real, calls = results._fs, []

    def failing(spark, path):
        fs, make = real(spark, path)

        class Once:
            def rename(self, here, there):
                calls.append(str(there))
                return False if len(calls) == 4 else fs.rename(here, there)  # the second table can't take its place

            def __getattr__(self, name):
                return getattr(fs, name)

        return Once(), make

    monkeypatch.setattr(results, "_fs", failing)
    with pytest.raises(OSError):
        results.publish({"course_enrollment_daily": daily(4), "course_activity": activity(4)}, root)
    monkeypatch.setattr(results, "_fs", real)
    assert counts() == (2, 2) and not list((tmp_path / "results").glob("_staged*"))
    results.publish({"course_activity": activity(5).limit(0)}, root, allow_empty=("course_activity",))
    assert results.read_result(spark, root, "course_activity").count() == 0


def test_files_of_bounded_size(spark, tmp_path):
    df = spark.range(1000).select(F.when(F.col("id") < 900, "hot").otherwise("cold").alias("k"), "id")
    sinks.parts_per_key(df, ["k"], str(tmp_path / "out"), rows=100)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 1000 and len(list((tmp_path / "out").glob("k=hot/*.parquet"))) >= 9


def test_engagement_reports(spark, tmp_path):
    report = spark.createDataFrame([("2024-01-07", "c", "ann", None, 2, 1)], "date string, course_id string, username string, cohort string, days_active int, problems_attempted int")
    for interval, date, active in (("daily", "Date", "Was Active"), ("weekly", "End Date", "Days Active This Week"), ("all", "End Date", "Days Active")):
        rows = sinks.engagement_rows(report, interval)
        assert rows.columns[:7] == ["Course ID", date, "Username", "Email", "Cohort", active, "Unique Problems Attempted"] and len(rows.columns) == 19
    sinks.write_engagement_csv(report, str(tmp_path / "r"), "all", "2024-01-01-2024-01-08")
    assert [p.parent.name for p in (tmp_path / "r").glob("*/*/*.csv")] == ["report=student_engagement_all_2024-01-01-2024-01-08"]
