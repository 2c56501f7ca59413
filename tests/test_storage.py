import datetime as dt
import os
import shutil

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymosaic.fixed_values import INDICATORS
from daymosaic.functions import sizing
from daymosaic.functions.sizing import fits_broadcast, materialise, measured_bytes, shared_folder
from daymosaic.plans import daily
from daymosaic.schemas import INDICATOR_DAYS, RESULTS, GridSpec
from daymosaic.sources import folders, ledger, readers, writers
from daymosaic.streaming.incremental import latest_delivery, rows_of_days, stream_days
from tests.test_flatten import layer, result

D1, D2 = dt.date(2025, 3, 7), dt.date(2025, 11, 18)


def days(spark, rows):
    df = spark.createDataFrame(rows, "point_id long, date date, v double")
    return df.withColumns({n: F.col("v") for n in INDICATORS}).withColumn(
        "geometry", F.struct(F.col("v").alias("x"), F.col("v").alias("y"))).drop("v")


def test_days_are_replaced_and_others_left_alone(spark, tmp_path):
    root = str(tmp_path / "d")
    writers.write_partitioned_day(days(spark, [(1, D1, 1.0), (2, D1, 2.0), (1, D2, 3.0)]), root)
    assert os.path.isdir(f"{root}/year=2025/month=3/day=7")
    for _ in range(2):                    # a repeated write changes nothing
        writers.write_partitioned_day(days(spark, [(9, D1, 9.0)]), root)
        got = {(r["point_id"], r["date"]) for r in readers.read_indicators(spark, root).collect()}
        assert got == {(9, D1), (1, D2)}


def test_files_are_limited_and_sorted(spark, tmp_path):
    root = str(tmp_path / "d")
    writers.write_partitioned_day(
        days(spark, [(i, D1, float(-i)) for i in range(100)]).coalesce(1), root, ["geometry.x"], rows_per_file=30)
    files = [f for f in os.listdir(f"{root}/year=2025/month=3/day=7") if f.endswith(".parquet")]
    assert len(files) >= 4
    for f in files:
        xs = [r["x"] for r in spark.read.parquet(f"{root}/year=2025/month=3/day=7/{f}").select("geometry.x").collect()]
        assert xs == sorted(xs) and len(xs) <= 30


def test_day_scan_reads_one_folder_and_the_asked_columns(spark, plan, tmp_path):
    root = str(tmp_path / "d")
    writers.write_partitioned_day(days(spark, [(1, D1, 1.0), (1, D2, 3.0)]), root)
    scan = readers.scan_day_partition(spark, root, D1, ["Theta", "PET"])
    assert all("year=2025/month=3/day=7" in f for f in scan.inputFiles())
    assert "REW" not in plan(scan)[plan(scan).index("ReadSchema"):]
    assert scan.columns == ["geometry", "Theta", "PET"] and scan.count() == 1
    assert readers.scan_day_partition(spark, root, dt.date(2030, 1, 1)).count() == 0
    ranged = readers.scan_date_range(spark, root, D1, D1, ["point_id", "Theta"])
    assert ranged.count() == 1 and "make_date" in plan(ranged)[plan(ranged).index("PartitionFilters"):]


def test_missing_column_is_an_error(spark, tmp_path):
    root = str(tmp_path / "d")
    writers.write_partitioned_day(days(spark, [(1, D1, 1.0)]).drop("Theta"), root)
    with pytest.raises(Exception, match="Theta"):
        readers.scan_day_partition(spark, root, D1)


def test_point_layer_drops_internal_columns(spark, tmp_path):
    df = days(spark, [(1, D1, 1.5)]).withColumns({"internalWater": F.lit(1), "internalPhenology": F.lit(2)})
    writers.write_point_layer(writers.point_layer(df, F.col("geometry.x"), F.col("geometry.y")), str(tmp_path / "p"))
    got = spark.read.parquet(str(tmp_path / "p"))
    assert not [c for c in got.columns if c.startswith("internal")] and got.first()["wkt"] == "POINT (1.5 1.5)"


def test_series_state_and_image_tables(spark, tmp_path):
    means = spark.createDataFrame([("comarca", D1, 1), ("municipio", D1, 2)], "admin_level string, date date, polygon_id int")
    writers.timeseries_publish(means, str(tmp_path / "t"))
    assert sorted(f for f in os.listdir(tmp_path / "t") if "=" in f) == ["admin_level=comarca", "admin_level=municipio"]
    writers.timeseries_publish(means.withColumn("date", F.lit(D2)), str(tmp_path / "t"))  # another day leaves the first one alone
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4
    states = spark.createDataFrame([(8, 1, D1, 5), (8, 1, D2, 6)], "province int, point_id long, date date, state long")
    writers.state_checkpoint(states, str(tmp_path / "s"))
    writers.state_checkpoint(states.where(F.col("date") == F.lit(D1)).withColumn("state", F.lit(7).cast("long")), str(tmp_path / "s"))
    assert {(r["date"], r["state"]) for r in spark.read.parquet(str(tmp_path / "s")).collect()} == {(D1, 7), (D2, 6)}
    images = spark.createDataFrame([("20250307", "PET", "x")], "date string, var string, base64_string string")
    writers.write_image_table(images, str(tmp_path / "i"))
    assert spark.read.parquet(str(tmp_path / "i")).count() == 1
    assert [r["path"] for r in writers.partition_paths(states.where("state = 5"), "s3://b/").collect()] == ["s3://b/year=2025/month=3/day=7/"]


def test_file_discovery(spark, tmp_path):
    for name in ("p_1_initialized.rds", "p_35_initialized.rds", "other.txt"):
        (tmp_path / name).write_text("x")
    files = readers.list_files(spark, str(tmp_path), "*initialized.rds")
    assert files.count() == 2 and readers.file_name_filter(files).count() == 1


def test_results_of_several_folders(spark, tmp_path):
    for i in (1, 2):
        spark.createDataFrame([result(i, [layer(1)], [(1.0, 0.5, 80.0)])], RESULTS).write.parquet(str(tmp_path / f"province_{i}"))
    assert readers.read_results(spark, str(tmp_path / "province_1"), str(tmp_path / "province_2")).count() == 2


def at(row, date):
    return (*row[:4], date, *row[5:])


OK = [(1.0, 0.5, 80.0)]


def deliver(spark, folder, *rows):
    spark.createDataFrame(list(rows), RESULTS).coalesce(1).write.mode("append").parquet(str(folder))


def datasets(tmp_path):
    return daily.indicator_days(str(tmp_path / "i")), daily.reject_days(str(tmp_path / "r"))


def published(spark, indicators):
    return sorted((r["point_id"], r["date"]) for r in ledger.read_published(spark, indicators).select("point_id", "date").collect())


def states(spark, indicators):
    return {r["day"]: (r["state"], r["accepted"], r["rejected"], r["seq"]) for r in ledger.current_days(spark, indicators).collect()}


def files_below(folder):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(folder) for f in names)


def test_days_are_published_repaired_failed_and_retired(spark, tmp_path):
    run, (indicators, rejects) = dt.date(2025, 11, 24), datasets(tmp_path)
    old, source = run - dt.timedelta(385), tmp_path / "results"
    for name, row in (("a", at(result(1, [layer(1)], OK), D2)), ("b", at(result(2, [layer(1)], OK, "failed"), D2)),
                      ("c", at(result(3, [layer(1)], OK), old)), ("d", result(4, [layer(1)], OK)),
                      ("e", at(result(5, [layer(1)], OK), run - dt.timedelta(400)))):
        deliver(spark, source / name, row)

    def publish(date):
        read = spark.read.schema(RESULTS).option("recursiveFileLookup", "true").parquet(str(source))
        return daily.publish_days(spark, read, indicators, rejects, date)

    assert publish(run) == [old, D1, D2]
    assert published(spark, indicators) == [(1, D2), (3, old), (4, D1)]
    assert states(spark, indicators) == {D1: ("published", 1, 0, 1), D2: ("published", 1, 1, 1), old: ("published", 1, 0, 1)}
    before = files_below(tmp_path)
    assert publish(run) == [] and files_below(tmp_path) == before       # nothing new: nothing is written
    shutil.rmtree(source / "b")
    deliver(spark, source / "b", at(result(2, [layer(1)], OK), D2))       # repaired
    shutil.rmtree(source / "d")
    deliver(spark, source / "d", result(4, [layer(1)], OK, "failed"))     # fails as a whole
    assert publish(run + dt.timedelta(1)) == [old, D1, D2]
    assert published(spark, indicators) == [(1, D2), (2, D2)]
    assert states(spark, indicators) == {D1: ("failed", 0, 1, 2), D2: ("published", 2, 0, 2), old: ("retired", 0, 0, 2)}
    assert [r["point_id"] for r in spark.read.parquet(rejects.root).collect()] == [4]
    assert {r["date"] for r in daily.processed_dates(spark, indicators.root).collect()} == {D2}
    assert publish(run + dt.timedelta(1)) == []                          # a failed day is done too


def test_a_broken_publication_is_finished_or_thrown_away(spark, tmp_path, monkeypatch):
    run, (indicators, rejects) = dt.date(2025, 11, 24), datasets(tmp_path)
    source = str(tmp_path / "results")

    def publish():
        return daily.publish_days(spark, spark.read.schema(RESULTS).parquet(source), indicators, rejects, run)

    deliver(spark, source, at(result(1, [layer(1)], OK), D2), result(2, [layer(1)], OK))
    publish()
    deliver(spark, source, at(result(3, [layer(1)], OK), D2), result(4, [layer(1)], OK))
    moved = []

    def stumble(session, a, b, move=folders.move):
        if moved:
            raise OSError("gone")
        moved.append(b)
        move(session, a, b)

    with monkeypatch.context() as m:
        m.setattr(folders, "move", stumble)
        with pytest.raises(OSError):
            publish()
    assert len(states(spark, indicators)) == 2 and {s[3] for s in states(spark, indicators).values()} == {1}
    assert publish() == []                                               # the plan is carried out first
    assert published(spark, indicators) == [(1, D2), (2, D1), (3, D2), (4, D1)]
    deliver(spark, source, result(5, [layer(1)], OK))
    with monkeypatch.context() as m:
        m.setattr(ledger, "_write_plan", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            publish()
    assert folders.matching(spark, indicators.root, "_staged/*")
    assert publish() == [D1] and not os.path.exists(f"{indicators.root}/_staged")
    assert len(published(spark, indicators)) == 5


def test_published_files_are_found_by_the_ledger_and_checked(spark, tmp_path):
    run, (indicators, rejects) = dt.date(2025, 11, 24), datasets(tmp_path)
    source = str(tmp_path / "results")
    deliver(spark, source, at(result(1, [layer(1)], OK), D2), result(2, [layer(1)], OK))
    daily.publish_days(spark, spark.read.schema(RESULTS).parquet(source), indicators, rejects, run)
    declared = daily.indicator_days(indicators.root, INDICATOR_DAYS)
    one = ledger.read_published(spark, declared, D2, D2)
    assert one.schema == INDICATOR_DAYS and [r["geometry"]["x"] is not None for r in one.collect()] == [True]
    assert all("year=2025/month=11/day=18" in f for f in one.inputFiles())
    files = {r["folder"]: r["rows"] for r in ledger.current_files(spark, indicators).collect()}
    assert files == {"year=2025/month=11/day=18": 1, "year=2025/month=3/day=7": 1}
    wrong = daily.indicator_days(indicators.root, T.StructType([*INDICATOR_DAYS.fields, T.StructField("more", T.LongType())]))
    with pytest.raises(ValueError, match="lacks more"):
        ledger.read_published(spark, wrong)
    empty = daily.indicator_days(str(tmp_path / "none"), INDICATOR_DAYS)
    assert ledger.read_published(spark, empty).count() == 0


def test_series_and_images_follow_their_days(spark, tmp_path):
    run, (indicators, rejects) = dt.date(2025, 11, 24), datasets(tmp_path)
    series, images = daily.series_days(str(tmp_path / "s")), daily.image_days(str(tmp_path / "m"))
    grid = GridSpec(400000.0, 440000.0, 4400000.0, 4440000.0, 1000.0)
    points = spark.createDataFrame([(1, i, 405000.0 + i, 4405000.0) for i in range(1, 6)], "province int, point_id long, x double, y double")
    square = "POLYGON ((400000 4400000, 440000 4400000, 440000 4440000, 400000 4440000, 400000 4400000))"
    polygons = spark.createDataFrame([("comarca", 1, "A", "P", "01", square)],
                                     "admin_level string, polygon_id int, name string, `ine.prov.name` string, cpro string, wkt string")
    source = str(tmp_path / "results")

    def publish(date=run):
        daily.publish_days(spark, spark.read.schema(RESULTS).parquet(source), indicators, rejects, date)
        return (daily.publish_series(spark, indicators, points, polygons, series, date),
                daily.publish_images(spark, indicators, points, grid, "point_id", 8, 8, images, date))

    deliver(spark, source, result(1, [layer(1)], OK), at(result(2, [layer(1)], OK), D2))
    assert publish() == ([D1, D2], [D1, D2]) and publish() == ([], [])
    kept = files_below(tmp_path / "m" / "date=20251118")
    deliver(spark, source, result(3, [layer(1)], OK))
    assert publish() == ([D1], [D1]) and files_below(tmp_path / "m" / "date=20251118") == kept
    gone = dt.date(2026, 3, 7) + dt.timedelta(50)
    assert publish(gone) == ([D1], [D1])                                  # D1 has left the window
    assert {r["date"] for r in spark.read.parquet(series.root).select("date").collect()} == {D2}
    assert spark.read.parquet(images.root).count() == 13


def test_row_groups_are_counted_in_rows(spark, tmp_path):
    many = days(spark, [(i, D1, float(i)) for i in range(12000)]).coalesce(1)
    writers.write_partitioned_day(many, str(tmp_path / "d"), ["geometry.x"])
    images = spark.range(26).selectExpr("'20250307' AS date", "CAST(id AS STRING) AS var", "'x' AS base64_string").coalesce(1)
    writers.write_image_table(images, str(tmp_path / "i"))

    def groups(folder):
        for f in files_below(folder):
            if f.endswith(".parquet"):
                footer = pq.ParquetFile(f).metadata
                yield [footer.row_group(k) for k in range(footer.num_row_groups)]

    (day,), (table,) = groups(tmp_path / "d"), groups(tmp_path / "i")
    assert [g.num_rows for g in day] == [5000, 5000, 2000] and [g.num_rows for g in table] == [11, 11, 4]
    xs = [c.statistics for g in day for c in (g.column(k) for k in range(g.num_columns)) if c.path_in_schema == "geometry.x"]
    assert [(s.min, s.max) for s in xs] == [(0.0, 4999.0), (5000.0, 9999.0), (10000.0, 11999.0)]   # a box skips groups


def test_arriving_files_update_whole_days(spark, tmp_path):
    run, (indicators, rejects) = dt.date(2025, 11, 24), datasets(tmp_path)
    source, log = str(tmp_path / "results"), str(tmp_path / "log")

    def arrive(*rows):
        deliver(spark, source, *rows)
        stream_days(spark, source, indicators, rejects, log, run)
        return published(spark, indicators)

    assert arrive(result(1, [layer(1)], OK), at(result(2, [layer(1)], OK), D2)) == [(1, D1), (2, D2)]
    assert arrive(result(3, [layer(1)], OK), result(4, [layer(1)], OK, "failed")) == [(1, D1), (2, D2), (3, D1)]
    assert [r["point_id"] for r in spark.read.parquet(rejects.root).collect()] == [4]
    assert arrive(result(4, [layer(1)], OK), result(1, [layer(1)], OK, "failed")) == [(2, D2), (3, D1), (4, D1)]   # the last delivery counts
    assert [r["point_id"] for r in spark.read.parquet(rejects.root).collect()] == [1]
    before = files_below(tmp_path / "i")
    stream_days(spark, source, indicators, rejects, log, run)                                     # nothing new
    assert files_below(tmp_path / "i") == before


def test_a_batch_run_again_publishes_nothing_twice(spark, tmp_path):
    run, (indicators, rejects) = dt.date(2025, 11, 24), datasets(tmp_path)
    source, log = str(tmp_path / "results"), str(tmp_path / "log")
    deliver(spark, source, result(1, [layer(1)], OK))
    stream_days(spark, source, indicators, rejects, log, run)
    for name in os.listdir(f"{log}/commits"):                              # as if it had stopped before it noted the batch
        os.remove(f"{log}/commits/{name}")
    before = files_below(tmp_path / "i")
    stream_days(spark, source, indicators, rejects, log, run)
    assert files_below(tmp_path / "i") == before and published(spark, indicators) == [(1, D1)]


def test_partitioned_results_are_pruned_to_the_touched_days(spark, plan, tmp_path):
    rows = [result(1, [layer(1)], OK), at(result(2, [layer(1)], OK), D2)]
    spark.createDataFrame(rows, RESULTS).write.partitionBy("province", "date").parquet(str(tmp_path / "r"))
    source = readers.read_results(spark, str(tmp_path / "r"))
    few = rows_of_days(source, spark.createDataFrame([(D2,)], "date date"))
    assert [r["point_id"] for r in few.collect()] == [2]
    filters = plan(few)[plan(few).index("PartitionFilters"):]
    assert "date" in filters[:filters.index("]")]
    indicators, rejects = datasets(tmp_path)
    stream_days(spark, str(tmp_path / "r"), indicators, rejects, str(tmp_path / "log"), dt.date(2025, 11, 24))
    assert ledger.read_published(spark, indicators).count() == 2


def test_latest_delivery_takes_one_row_a_key(spark, tmp_path):
    deliver(spark, tmp_path / "r", result(1, [layer(1)], OK), result(1, [layer(1)], OK))
    assert latest_delivery(spark.read.schema(RESULTS).parquet(str(tmp_path / "r"))).count() == 1


def test_broadcast_bound_counts_bytes(spark):
    df = spark.createDataFrame([(1, "abcd", [1.0, 2.0], [([1],)])], "a long, b string, c array<double>, d array<struct<e:array<long>>>")
    assert measured_bytes(df) == 32 + 8 + (4 + 16) + (16 + 16) + (8 + 16 + 16 + 16)
    assert fits_broadcast(df, 1000) and not fits_broadcast(df, 50)
    assert fits_broadcast(spark.range(5), 10**6, at_most_rows=5)
    words = spark.createDataFrame([("a",)], "w string")
    assert fits_broadcast(words, 1000, at_most_rows=10, text_bytes=9) and not fits_broadcast(words, 40, 10, 9)


def test_lineage_is_cut_in_the_shared_folder(spark, plan):
    assert shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    cut, rows = materialise(spark.range(10).groupBy((F.col("id") % 3).alias("k")).count(), "x")
    assert cut.count() == rows == 3 and "Aggregate" not in plan(cut)


def test_intermediate_folders_can_be_removed(spark):
    _, rows = materialise(spark.range(3), "gone")
    root = spark.conf.get("spark.checkpoint.dir")
    before = {f for f in os.listdir(root) if f.startswith("gone-")}
    assert rows == 3 and before
    kept, made = list(sizing._made), [p for p in sizing._made if "/gone-" in p]
    sizing._made[:] = made
    try:
        assert sizing.remove_intermediates(spark) == len(made)
    finally:
        sizing._made[:] = [p for p in kept if p not in made]
    assert not [f for f in os.listdir(root) if f.startswith("gone-")]


def test_only_the_latest_rows_asked_for_come_out(spark, tmp_path):
    source = str(tmp_path / "results")
    deliver(spark, source, result(1, [layer(1)], OK), result(2, [layer(1)], OK))
    deliver(spark, source, at(result(1, [layer(1)], OK), D2))

    def latest(day):
        rows = latest_delivery(spark.read.schema(RESULTS).parquet(source), ("province", "point_id"), F.col("date") == F.lit(day))
        return sorted((r["point_id"], r["date"]) for r in rows.collect())

    assert latest(D1) == [(2, D1)] and latest(D2) == [(1, D2)]              # what counts of the first was delivered for another day


def test_a_batch_finds_its_latest_rows_once(spark, tmp_path):
    run, (indicators, rejects) = dt.date(2025, 11, 24), datasets(tmp_path)
    deliver(spark, str(tmp_path / "r"), result(1, [layer(1)], OK), result(2, [layer(1)], OK, "failed"))
    before = len(sizing._made)
    stream_days(spark, str(tmp_path / "r"), indicators, rejects, str(tmp_path / "log"), run)
    assert sum("/asked-" in p for p in sizing._made[before:]) == 1 and published(spark, indicators) == [(1, D1)]
