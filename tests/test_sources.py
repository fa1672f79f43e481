"""Reading, writing and housekeeping against a scratch warehouse."""

from __future__ import annotations

import threading
from datetime import date

import pytest
from pyspark.sql import functions as F

from loadlens.sources import sinks, tables
from loadlens.sources.slices import Conflict, SliceTable


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_overwrite_table_matches_by_name(spark):
    spark.sql("CREATE TABLE target_a (id INT, name STRING) USING parquet")
    sinks.overwrite_table(spark.createDataFrame([("x", 1)], "name string, id int"), "target_a")
    sinks.overwrite_table(spark.createDataFrame([("y", 2)], "name string, id int"), "target_a")
    tables.refresh(spark, "target_a")
    assert rows_of(tables.read_table(spark, "target_a")) == [(2, "y")]


def test_overwrite_slice_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "report")
    df = spark.createDataFrame([("n", 1), ("s", 2)], "box string, v int")
    df.write.partitionBy("box").parquet(path)
    sinks.overwrite_slice(spark.createDataFrame([("n", 9)], "box string, v int"), path, {"box": "n"})
    assert rows_of(spark.read.parquet(path).select("box", "v")) == [("n", 9), ("s", 2)]
    with pytest.raises(Exception, match="outside the slice"):
        sinks.overwrite_slice(df, path, {"box": "n"})
    assert rows_of(spark.read.parquet(path).select("box", "v")) == [("n", 9), ("s", 2)]
    sinks.overwrite_slice(df.limit(0), path, {"box": "n"})
    assert rows_of(spark.read.parquet(path).select("box", "v")) == [("s", 2)]


def test_overwrite_slice_of_a_number(spark, tmp_path):
    path = str(tmp_path / "numbers")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "m int, v string")
    df.write.partitionBy("m").parquet(path)
    sinks.overwrite_slice(df.where("m = 2").withColumn("v", F.lit("c")), path, {"m": "2"})
    assert rows_of(spark.read.parquet(path).select("m", "v")) == [(1, "a"), (2, "c")]
    with pytest.raises(Exception, match="outside the slice"):
        sinks.overwrite_slice(df, path, {"m": "2"})


def test_a_side_table_made_of_itself(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS self")
    sinks.checkpoint_table(spark.range(3), "self.t", str(tmp_path))
    doubled = sinks.checkpoint_table(spark.table("self.t").selectExpr("id * 2 AS id"), "self.t", str(tmp_path))
    assert rows_of(doubled) == [(0,), (2,), (4,)]
    with pytest.raises(Exception):
        sinks.checkpoint_table(spark.table("self.t").selectExpr("raise_error('x') AS id"), "self.t", str(tmp_path))
    assert spark.table("self.t").count() == 3


def test_staged_folders_can_be_cleaned(spark, tmp_path):
    folder = tmp_path / "given"
    sinks.staged(spark.range(2), str(folder))
    assert list(folder.iterdir())
    sinks.clean_staged(spark)
    assert not list(folder.iterdir())


def test_side_tables_and_suffix_drop(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS side")
    df = spark.range(3)
    assert sinks.checkpoint_table(df, "side.step1_debug", str(tmp_path)).count() == 3
    sinks.checkpoint_table(df, "side.step2_DEBUG", str(tmp_path))
    sinks.checkpoint_table(df, "side.kept", str(tmp_path))
    assert len(sinks.drop_tables_with_suffix(spark, "side", "_debug")) == 2
    assert [t.name for t in spark.catalog.listTables("side") if not t.isTemporary] == ["kept"]


@pytest.mark.parametrize("mode", [0, 1, 2, 3])
def test_manage_output(spark, mode):
    df = sinks.manage_output(spark.range(5), f"kept_{mode}", mode)
    assert df.count() == 5
    if mode < 2:
        assert spark.table(f"kept_{mode}").count() == 5
        assert spark.catalog.isCached(f"kept_{mode}") == (mode == 1)
    df.unpersist()


def test_drop_partition(spark, tmp_path):
    path = str(tmp_path / "parts")
    spark.sql(f"CREATE TABLE parts (v INT, m STRING) USING parquet PARTITIONED BY (m) LOCATION '{path}'")
    spark.createDataFrame([(1, "a"), (2, "b")], "v int, m string").write.insertInto("parts", overwrite=True)
    sinks.drop_partition(spark, "parts", {"m": "a"}, purge_path=path)
    assert rows_of(spark.table("parts")) == [(2, "b")]
    assert not (tmp_path / "parts" / "m=a").exists()


def test_staged_reads_back_below_the_checkpoint_folder(spark):
    df = sinks.staged(spark.range(4).withColumn("s", F.struct("id")))
    assert df.count() == 4
    assert spark.conf.get("spark.checkpoint.dir") in df.inputFiles()[0]


def test_date_spine_and_names(spark):
    assert [r[1] for r in tables.date_spine(spark, date(2024, 2, 28), date(2024, 3, 1), "yyyyMMdd").collect()] == [
        "20240228", "20240229", "20240301",
    ]
    assert tables.date_spine(spark, date(2024, 2, 2), date(2024, 2, 1)).count() == 0
    assert rows_of(tables.names_frame(spark, ["b", "a"])) == [("a",), ("b",)]


def test_params_and_files(spark, sf_dir):
    params = spark.createDataFrame([("g", "n", "v"), ("h", "m", "w")], "param_group_name string, param_name string, param_val string")
    assert rows_of(tables.read_params(params, "g")) == [("n", "v")]
    assert tables.read_params(params).count() == 2
    files = tables.file_inventory(spark, sf_dir)
    assert files.where(F.col("path").endswith("lineitem.parquet") & F.col("dir").endswith(sf_dir)).count() == 1



def slices_of(spark, path):
    table = SliceTable(spark, f"file:{path}/t", ["box"])
    for box in "abc":
        table.replace(spark.createDataFrame([(box, 1), (box, 2)], "box string, v int"), {"box": box})
    return table


def test_slices_read_write_and_vacuum(spark, tmp_path):
    table = slices_of(spark, tmp_path)
    assert table.version() == 3 and table.read().count() == 6
    assert rows_of(table.read(slices=[{"box": "b"}])) == [("b", 1), ("b", 2)]
    table.replace(spark.createDataFrame([(9, "b")], "v int, box string"), {"box": "b"})  # by name
    assert rows_of(table.read()) == [("a", 1), ("a", 2), ("b", 9), ("c", 1), ("c", 2)]
    assert rows_of(table.read(3, [{"box": "b"}])) == [("b", 1), ("b", 2)]
    table.replace(table.read().limit(0), {"box": "c"})  # an empty slice
    table.replace(spark.createDataFrame([(None, 4)], "box string, v int"), {"box": None})
    table.drop({"box": "a"})
    assert {tuple(r) for r in table.read().collect()} == {("b", 9), (None, 4)}
    for odd in (spark.createDataFrame([("b", 1), ("x", 1)], "box string, v int"), spark.createDataFrame([(None, 1)], "box string, v int")):
        with pytest.raises(Exception, match="outside the slice"):
            table.replace(odd, {"box": "b"})
    with pytest.raises(ValueError):
        table.replace(spark.createDataFrame([("b", "t")], "box string, v string"), {"box": "b"})
    assert table.version() == 7 and len(list((tmp_path / "t" / "data").iterdir())) == 6
    assert table.vacuum(keep=1) == 3 and {tuple(r) for r in table.read().collect()} == {("b", 9), (None, 4)}
    with pytest.raises(ValueError):
        SliceTable(spark, str(tmp_path / "none"), ["box"]).read()


def test_slices_conflicts(spark, tmp_path):
    table = slices_of(spark, tmp_path)
    base = table.version()
    mine = spark.createDataFrame([("a", 5)], "box string, v int")
    table.replace(mine, {"box": "a"}, based_on=base)
    with pytest.raises(Conflict):  # the same slice
        table.replace(mine, {"box": "a"}, based_on=base, reads=())
    other = spark.createDataFrame([("b", 5)], "box string, v int")
    with pytest.raises(Conflict):  # made from what the first write has changed
        table.replace(other, {"box": "b"}, based_on=base, reads=[{"box": "a"}])
    with pytest.raises(Conflict):  # may be made from anything
        table.replace(other, {"box": "b"}, based_on=base)
    assert table.version() == base + 1 and len(list((tmp_path / "t" / "data").iterdir())) == 4  # nothing left behind
    table.replace(other, {"box": "b"}, based_on=base, reads=[{"box": "c"}])
    assert rows_of(table.read()) == [("a", 5), ("b", 5), ("c", 1), ("c", 2)]


def test_two_writers_at_once_and_a_reader(spark, tmp_path):
    """Of writers that start from one version and put the next in place at once, one succeeds; a reader
    in between sees whole versions."""
    table = slices_of(spark, tmp_path)
    gate, results = threading.Barrier(2), []
    stop, seen, errors = threading.Event(), set(), []

    def write(value):
        own = SliceTable(spark, f"file:{tmp_path}/t", ["box"])
        put = own._put

        def together(version, manifest):
            if version == 4:
                gate.wait(60)
            return put(version, manifest)

        own._put = together
        try:
            own.replace(spark.createDataFrame([("a", value)] * 50, "box string, v int").repartition(5), {"box": "a"}, based_on=3)
            results.append(value)
        except Conflict as e:
            results.append(str(e))

    def look():
        while not stop.is_set():
            try:
                seen.add(tuple(sorted(r["v"] for r in table.read(slices=[{"box": "a"}]).collect())))
            except Exception as e:  # noqa: BLE001
                errors.append(e)

    reader = threading.Thread(target=look)
    reader.start()
    writers = [threading.Thread(target=write, args=(v,)) for v in (10, 20)]
    for w in writers:
        w.start()
    for w in writers:
        w.join(120)
    stop.set()
    reader.join(60)
    won = [r for r in results if isinstance(r, int)]
    assert len(results) == 2 and len(won) == 1 and table.version() == 4 and not errors
    assert seen <= {(1, 2), (won[0],) * 50}
    assert rows_of(table.read(slices=[{"box": "a"}])) == [("a", won[0])] * 50


def test_a_side_table_is_never_missing(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS steady")
    sinks.checkpoint_table(spark.range(5).selectExpr("id", "0 AS v"), "steady.t", str(tmp_path))
    stop, seen, errors = threading.Event(), set(), []

    def look():
        while not stop.is_set():
            try:
                seen.add(tuple(r["v"] for r in spark.table("steady.t").select("v").collect()))
            except Exception as e:  # noqa: BLE001
                errors.append(e)

    reader = threading.Thread(target=look)
    reader.start()
    for k in range(1, 9):
        extra = [f"{k} AS extra"] if k > 4 else []  # columns may change
        sinks.checkpoint_table(spark.table("steady.t").selectExpr("id", "v + 1 AS v", *extra), "steady.t", str(tmp_path))
    stop.set()
    reader.join(60)
    assert not errors and seen <= {(k,) * 5 for k in range(9)}
    assert spark.table("steady.t").columns == ["id", "v", "extra"]


def test_a_plain_table_becomes_a_side_table(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS old")
    spark.range(2).write.format("parquet").option("path", str(tmp_path / "o")).saveAsTable("old.t")
    assert sinks.checkpoint_table(spark.table("old.t").selectExpr("id + 5 AS id"), "old.t", str(tmp_path)).count() == 2
    assert rows_of(spark.table("old.t")) == [(5,), (6,)]
