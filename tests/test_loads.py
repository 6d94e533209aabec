"""Readers, writers, load modes, watermarks, logs and streams."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakeproof.operators.mapping import ColumnMap, split_incompatible
from lakeproof.plans import ingest, runlog, watermark
from lakeproof.session import scratch_path, shared_root
from lakeproof.sinks import files as sinks
from lakeproof.sinks import loads, versions
from lakeproof.sinks.fingerprint import copy_consistency
from lakeproof.sinks.versions import read_table
from lakeproof.sources import control, files, jdbc, tables
from lakeproof.streaming.ingest import file_stream, ingest_available
from lakeproof.streaming.windows import windowed_frequencies


@pytest.fixture
def new(spark):
    return lambda label: scratch_path(spark, label)


def test_shared_folder_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_root(spark) == named


def test_dialects(spark, tmp_path):
    (tmp_path / "a.csv").write_text('h 1,h2\n"say \\"hi\\", now",ខ្មែរ\n')
    assert files.read_csv(spark, str(tmp_path / "a.csv")).first() == ('say "hi", now', "ខ្មែរ")
    (tmp_path / "b.csv").write_text('h1\n"say ""hi"""\n')
    assert files.read_csv(spark, str(tmp_path / "b.csv"), files.DOUBLED_QUOTE).first() == ('say "hi"',)
    (tmp_path / "c.csv").write_text('h1\n"line\nbreak"\n')
    assert files.read_csv(spark, str(tmp_path / "c.csv"), multiline=True).first() == ("line\nbreak",)


def test_malformed_rows_do_not_depend_on_the_query(spark, tmp_path):
    (tmp_path / "d.csv").write_text("n,t\n1,a\nx,b\n3\n4,c,extra\n,e\n")
    df = files.read_csv(spark, str(tmp_path / "d.csv"), schema="n int, t string", drop_malformed=True)
    assert [tuple(r) for r in df.collect()] == [(1, "a"), (None, "e")]
    assert df.count() == 2
    assert [r.t for r in df.select("t").collect()] == ["a", "e"]
    with pytest.raises(ValueError):
        files.read_csv(spark, str(tmp_path / "d.csv"), drop_malformed=True)


def test_xml_keeps_namespaces(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<r><p:row xmlns:p="u"><p:v>1</p:v></p:row><p:row xmlns:p="u"><p:v>2</p:v></p:row></r>')
    df = files.read_xml(spark, str(tmp_path / "a.xml"), "p:row", "`p:v` int")
    assert sorted(r[0] for r in df.collect()) == [1, 2]


def test_read_files_dispatch(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1}, {"a": 2}]')
    assert files.read_files(spark, str(tmp_path / "a.json"), "json").count() == 2
    with pytest.raises(ValueError):
        files.read_files(spark, "x", "xls")


def test_table_by_name(spark):
    spark.range(3).createOrReplaceTempView("three")
    assert tables.read_table(spark, "three").count() == 3
    assert tables.read_query(spark, "SELECT max(id) FROM {t}", t=spark.range(5)).first()[0] == 4


def test_jdbc_options():
    parts = jdbc.JdbcPartitions("id", "0", "1000", 8)
    table = jdbc.read_options("jdbc:x", table="s.t", partitions=parts, connection={"driver": "d"})
    assert table == {
        "url": "jdbc:x", "dbtable": "s.t", "fetchsize": "10000", "driver": "d", "partitionColumn": "id",
        "lowerBound": "0", "upperBound": "1000", "numPartitions": "8",
    }
    assert jdbc.read_options("jdbc:x", query="select 1")["query"] == "select 1"
    assert jdbc.read_options("jdbc:x", query="select 1 ;", partitions=parts)["dbtable"] == "(select 1 ) src"
    with pytest.raises(ValueError):
        jdbc.read_options("jdbc:x", table="t", query="select 1")
    with pytest.raises(ValueError):
        jdbc.read_options("jdbc:x")
    written = jdbc.write_options("jdbc:x", "s.t", truncate=True, column_types={"a": "NVARCHAR(20)", "b": "INT"}, connections=4)
    assert written["truncate"] == "true" and written["createTableColumnTypes"] == "a NVARCHAR(20), b INT"
    assert written["numPartitions"] == "4"


def test_control_records(spark):
    text = '[{"FwkConfigId": 1, "SourceType": "Oracle", "FwkTriggerId": 2, "BatchGroupId": 3, "ActiveFlag": "Y", "extra": 0}, {"FwkConfigId": 2}]'
    config = control.parse_config(spark.createDataFrame([(text,)], "config string"))
    assert config.count() == 2 and len(config.columns) == 24
    assert control.config_for_source(config, "Oracle").first().FwkConfigId == 1
    assert [r[0] for r in control.batch_groups(config, 2).collect()] == [3]


def test_reject_threshold(spark, new):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "n string")
    mapping, target, bad = [ColumnMap("n", "N", "int")], new("t"), new("bad")
    with pytest.raises(loads.LoadRejected):
        loads.load_with_threshold(df, mapping, target, max_rejects=0, reject_path=bad)
    assert spark.read.parquet(bad).first().n == "x"
    with pytest.raises(versions.NoVersion):
        read_table(spark, target)
    assert loads.load_with_threshold(df, mapping, target, max_rejects=1) == 1
    assert sorted(r.N for r in read_table(spark, target).collect()) == [0, 1]


def test_consistency_sees_repeated_and_changed_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "n int, t string")
    assert copy_consistency(df, df.repartition(5).withColumn("audit", F.lit(1))).first().consistent
    pairs = spark.createDataFrame([(3, "c"), (3, "c"), (2, None)], "n int, t string")
    assert not copy_consistency(df, pairs).first().consistent
    empty = df.limit(0)
    assert copy_consistency(empty, empty).first() == (0, 0, True)


def test_merge_writes_as_many_files_as_asked(spark, new):
    df = spark.range(1000).selectExpr("id", "concat('\"', id, ' text') as t")
    sources = [new("m"), new("m")]
    sinks.write_csv(df, sources[0])
    sinks.write_csv(df.select("t", "id"), sources[1])
    one, many = new("one"), new("many")
    sinks.merge_text_files(spark, sources, one)
    sinks.merge_text_files(spark, sources, many, files=3)
    for path, count in ((one, 1), (many, 3)):
        merged = files.read_csv(spark, path)
        assert merged.count() == 2000 and merged.where("id = '7' AND t = '\"7 text'").count() == 2
        assert len(spark.read.text(path).inputFiles()) == count
    other = new("other")
    sinks.write_csv(df.withColumnRenamed("t", "u"), other)
    with pytest.raises(ValueError):
        sinks.merge_text_files(spark, [*sources, other], new("never"))
    sinks.write_single_csv(df, one + "-s")
    assert len(spark.read.text(one + "-s").inputFiles()) == 1


def test_consistency_sees_values_in_another_column(spark):
    source = spark.createDataFrame([("x", None), (None, "y")], "a string, b string")
    target = spark.createDataFrame([(None, "x"), ("y", None)], "a string, b string")
    assert not copy_consistency(source, target).first().consistent


def test_text_survives_metric_files(spark, new):
    values = [None, "", " padded ", 'a"b', "a|b", "line\nbreak", "tab\t", "back\\", "\\", '\\"', "cr\r\nlf", "ខ្មែរ", "null"]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v string, n bigint")
    path = new("text")
    sinks.write_metrics(df, path)
    assert [r.v for r in sinks.read_metrics(spark, path, "v string, n bigint").orderBy("n").collect()] == values


def test_void_columns_are_stored(spark, new):
    path = new("void")
    sinks.write_parquet(spark.range(2).withColumn("nothing", F.lit(None)), path)
    assert dict(spark.read.parquet(path).dtypes)["nothing"] == "string"


def events(spark, rows):
    return spark.createDataFrame(rows, "id int, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))


def test_watermark_survives_a_failed_run(spark, new, monkeypatch):
    target, marks = new("w"), new("marks")
    first = events(spark, [(1, "2024-01-01 00:00:00"), (2, "2024-01-02 00:00:00.5")])
    more = first.union(events(spark, [(3, "2024-01-03 00:00:00")]))
    assert watermark.read_mark(spark, marks, 1, "t") is None
    assert watermark.advance(spark, first, "at", target, marks, 1, "t") == "2024-01-02 00:00:00.5"
    # a run that committed its rows but died before it moved the mark
    versions.put_increment(watermark.delta(more, "at", 0, "2024-01-02 00:00:00.5"), target, "2024-01-02 00:00:00.5")
    assert watermark.advance(spark, more, "at", target, marks, 1, "t") == "2024-01-03 00:00:00"
    assert watermark.advance(spark, more, "at", target, marks, 1, "t") == "2024-01-03 00:00:00"
    assert sorted(r.id for r in read_table(spark, target).collect()) == [1, 2, 3]
    assert watermark.read_mark(spark, marks, 2, "t") is None
    # a full load replaces the increments
    watermark.advance(spark, more, "at", target, marks, 1, "t", watermark.FULL_LOAD)
    assert sorted(r.id for r in read_table(spark, target).collect()) == [1, 2, 3]
    # a full reload that replaced everything but died before it moved the mark
    last = more.union(events(spark, [(4, "2024-01-04 00:00:00")]))
    record = watermark._record

    def die(*args):
        if args[5] == watermark.COMMITTED:
            raise RuntimeError("lost")
        record(*args)

    monkeypatch.setattr(watermark, "_record", die)
    with pytest.raises(RuntimeError):
        watermark.advance(spark, last, "at", target, marks, 1, "t", watermark.FULL_LOAD)
    monkeypatch.setattr(watermark, "_record", record)
    assert watermark.advance(spark, last, "at", target, marks, 1, "t") == "2024-01-04 00:00:00"
    assert watermark.advance(spark, last, "at", target, marks, 1, "t") == "2024-01-04 00:00:00"
    assert sorted(r.id for r in read_table(spark, target).collect()) == [1, 2, 3, 4]


def test_columns_named_like_helpers(spark, new):
    df = spark.createDataFrame([("1", "x", "y"), ("z", "x", "y")], "n string, bad string, bad_columns string")
    mapping, target, rejects = [ColumnMap("n", "N", "int"), ColumnMap("bad_columns", "B", "nvarchar")], new("t"), new("bad")
    assert loads.load_with_threshold(df, mapping, target, None, reject_path=rejects) == 1
    assert [tuple(r) for r in read_table(spark, target).collect()] == [(1, "y")]
    assert [tuple(r) for r in spark.read.parquet(rejects).collect()] == [("z", "x", "y", "n")]
    good, bad = split_incompatible(df, mapping)
    assert [tuple(r) for r in good.collect()] == [(1, "y")] and [tuple(r) for r in bad.collect()] == [("z", "x", "y", "n")]


def test_a_version_replaces_the_other_in_one_step(spark, new, monkeypatch):
    path = new("v")
    with pytest.raises(versions.NoVersion):
        read_table(spark, path)
    assert versions.replace_table(spark.range(5), path).number == 1
    reader = read_table(spark, path)
    # a writer whose rows fail to compute half-way
    with pytest.raises(PySparkException):
        versions.replace_table(spark.range(9).selectExpr("id", "raise_error('no') as x"), path)
    # one that dies before its commit
    monkeypatch.setattr(versions, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        versions.replace_table(spark.range(7), path)
    monkeypatch.undo()
    assert read_table(spark, path).count() == 5
    versions.replace_table(spark.range(2), path)
    assert reader.count() == 5 and read_table(spark, path).count() == 2 and read_table(spark, path, 1).count() == 5
    with pytest.raises(versions.NoVersion):
        read_table(spark, path, 9)


def test_of_two_writers_one_succeeds(spark, new):
    path = new("v")
    versions.replace_table(spark.range(1), path)
    first, second = versions.write_part(spark.range(2), path), versions.write_part(spark.range(3), path)
    versions.commit(spark, path, [first], spark.range(2).schema, after=1)
    with pytest.raises(versions.CommitConflict):
        versions.commit(spark, path, [second], spark.range(3).schema, after=1)
    with pytest.raises(versions.CommitConflict):
        versions._Folder(spark, path).create("_commits/0000000002.json", "{}")
    assert read_table(spark, path).count() == 2


def test_increments_by_key(spark, new):
    path = new("v")
    versions.put_increment(spark.range(0, 2), path, None)
    for key, end in (("A-1", 5), ("A/1", 6), ("A-1", 3), ("first", 4), ("", 3)):
        versions.put_increment(spark.range(2, end), path, key)
    found = sorted((r["k"] or "none", r["id"]) for r in read_table(spark, path, key_column="k").collect())
    assert found == [("A-1", 2), ("A/1", 2), ("A/1", 3), ("A/1", 4), ("A/1", 5), ("first", 2), ("first", 3), ("none", 0), ("none", 1), ("none", 2)]
    with pytest.raises(ValueError):
        read_table(spark, path, key_column="ID")
    with pytest.raises(ValueError):
        versions.put_increment(spark.range(1).withColumn("x", F.lit(1)), path, "more")
    before = read_table(spark, path).count()
    assert versions.compact(spark, path).parts[0].key is None and read_table(spark, path).count() == before
    assert versions.drop_old_versions(spark, path) == [1, 2, 3, 4, 5, 6] and read_table(spark, path).count() == before
    assert len(versions._Folder(spark, path).names("")) == 2
    versions.commit(spark, path, [], spark.range(1).schema)
    assert read_table(spark, path).collect() == []


def test_a_copy_that_differs_is_not_published(spark, new, monkeypatch):
    raw, published = new("raw"), new("pub")
    spark.range(5).write.parquet(raw)
    assert loads.publish(spark, raw, published) == 5
    spark.range(9).write.mode("overwrite").parquet(raw)
    monkeypatch.setattr(loads, "write_part", lambda df, path: versions.write_part(df.limit(3), path))
    with pytest.raises(loads.CopyMismatch):
        loads.publish(spark, raw, published)
    assert read_table(spark, published).count() == 5
    monkeypatch.undo()
    assert loads.publish(spark, raw, published, check=False) == 9


def test_marks_that_differ_in_signs(spark, new):
    target, marks = new("w"), new("marks")
    rows = [("A-1",), ("A/1",), ("B",), ("first",)]
    for k in range(len(rows)):
        watermark.advance(spark, spark.createDataFrame(rows[:k + 1], "since string"), "since", target, marks, 1, "t")
    assert sorted(r.since for r in read_table(spark, target).collect()) == ["A-1", "A/1", "B", "first"]
    assert [p.key for p in versions.version_of(spark, target).parts] == [None, "A-1", "A/1", "B"]


def test_delta_is_pushed_into_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = watermark.delta(df, "ts", 0, datetime(2024, 1, 11))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts,2024-01-11T00:00)]" in plan


def test_run_log(spark, new):
    path, run = new("log"), ingest.RunContext("r1", datetime(2024, 1, 1)).record()
    runlog.start_run(spark, path, run, datetime(2024, 1, 1))
    assert runlog.latest_status(spark.read.parquet(path)).first().PipelineStatus is None
    runlog.finish_run(spark, path, run, False, datetime(2024, 1, 1, 1))
    assert runlog.latest_status(spark.read.parquet(path)).first().PipelineStatus == "Failed"
    # the machine that ends the run is hours behind the one that began it
    run = ingest.RunContext("r2", datetime(2024, 1, 1)).record()
    runlog.start_run(spark, path, run, datetime(2024, 1, 2, 7))
    runlog.finish_run(spark, path, run, True, datetime(2024, 1, 2))
    status = {r.ModuleRunId: r.PipelineStatus for r in runlog.latest_status(spark.read.parquet(path)).collect()}
    assert status == {"r1": "Failed", "r2": "Success"}


def test_load_table_lands_publishes_and_logs(spark, new):
    lake, log = new("lake"), new("log")
    load = ingest.TableLoad("ERP", "s", "orders", "NZ", "MM", [ColumnMap("id", "ID", "bigint")])
    run = ingest.RunContext("r9", datetime(2024, 2, 3, 4, 5))
    path, rows = ingest.load_table(spark, spark.range(5), load, run, lake, log)
    assert path == f"{lake}/Published/NZ/Full/ERP/ORDERS/2024/02/S_ORDERS_2024_02_03_04_05.parquet" and rows == 5
    assert read_table(spark, path).columns == ["ID", "LastUpdate", "CreatedBy"]
    assert runlog.latest_status(spark.read.parquet(log)).first().PipelineStatus == "Success"
    missing = ingest.TableLoad("ERP", "s", "orders", "NZ", "MM", [ColumnMap("nope", "ID", "bigint")])
    errors = new("errors")
    with pytest.raises(PySparkException):
        ingest.load_table(spark, spark.range(5), missing, run, lake, log, errors)
    logged = spark.read.parquet(errors).first()
    assert (logged.PipelineName, logged.PipelineRunId, logged.Activity_Name) == ("ERP.s.orders", "r9", "Map")
    assert "nope" in logged.ErrorMessage and logged.ErrorLoggedTime is not None


def test_stream_equals_batch_after_restart(spark, new):
    landing, target, checkpoint = new("in"), new("out"), new("cp")
    schema = "id int, at timestamp_ntz"
    for i in range(3):
        events(spark, [(i, "2024-01-01 00:00:00")]).write.mode("append").parquet(landing)
        ingest_available(file_stream(spark, landing, schema, files_per_trigger=1), target, checkpoint)
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [0, 1, 2]


def test_late_rows_are_dropped_once_their_window_is_out(spark, new):
    landing, target, checkpoint = new("in"), new("out"), new("cp")
    for rows in (
        [("a", "2024-01-01 00:05:00"), ("a", "2024-01-01 03:00:00")],
        [("a", "2024-01-01 00:10:00"), ("a", "2024-01-01 02:55:00"), ("b", "2024-01-01 06:00:00")],
    ):
        df = spark.createDataFrame(rows, "kind string, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))
        df.write.mode("append").parquet(landing)
        stream = file_stream(spark, landing, "kind string, at timestamp_ntz")
        ingest_available(windowed_frequencies(stream, "at", "kind"), target, checkpoint)
    found = {(r.window_start.hour, r.kind): r.freq for r in spark.read.parquet(target).collect()}
    assert found == {(0, "a"): 1, (2, "a"): 1, (3, "a"): 1}
