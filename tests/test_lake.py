"""Paths, zones, inventories, archives, checksums, retention and transactional folders on real files."""

import hashlib
import os
import uuid
import zipfile
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakeproof.catalog.staging import make_folders
from lakeproof.functions import lake_paths
from lakeproof.functions.zones import iana_zone, utc_to_local
from lakeproof.operators import inventory
from lakeproof.operators.acid import read_events, resolve_rows, flatten_rows, table_dirs
from lakeproof.sinks.retention import delete_folders, retention_candidates
from lakeproof.sources import archives, checksums
from lakeproof.sources.files import CsvDialect
from lakeproof.sources.listing import modified_between, relative_to, walk_files, walk_folders

WHEN = datetime(2021, 12, 31, 23, 5)


def test_dated_paths_agree(spark):
    expected = {
        "YY": "Raw/NZ/Full/ERP/ORDERS/2021/S_ORDERS_2021_12_31_23_05.parquet",
        "MM": "Raw/NZ/Full/ERP/ORDERS/2021/12/S_ORDERS_2021_12_31_23_05.parquet",
        "DD": "Raw/NZ/Full/ERP/ORDERS/2021/12/31/S_ORDERS_2021_12_31_23_05.parquet",
        "HH": "Raw/NZ/Full/ERP/ORDERS/2021/12/31/23/S_ORDERS_2021_12_31_23_05.parquet",
        "other": "Raw/NZ/Full/ERP/ORDERS/S_ORDERS_2021_12_31_23_05.parquet",
    }
    lits = [F.lit(x) for x in ("Raw", "NZ", "ERP", "s", "orders")]
    for granularity, path in expected.items():
        assert lake_paths.dated_path("Raw", "NZ", "ERP", "s", "orders", WHEN, granularity) == path
        column = lake_paths.dated_path_column(*lits, F.lit(WHEN).cast("timestamp_ntz"), F.lit(granularity))
        assert spark.range(1).select(column).first()[0] == path
    assert lake_paths.daily_file_name("feed_", datetime(2022, 1, 1)) == "feed_2021-12-31.zip"


def test_zones(spark):
    assert iana_zone("SE Asia Standard time") == "Asia/Bangkok"
    with pytest.raises(ValueError):
        iana_zone("Mars Standard Time")
    at = spark.sql("select timestamp'2021-12-31 20:00:00' as t")
    assert at.select(F.date_format(utc_to_local(F.col("t"), F.lit("China Standard Time")), "yyyy-MM-dd HH")).first()[0] == "2022-01-01 04"


@pytest.fixture
def lake(tmp_path):
    for path, size in {
        "a/b/one.parquet": 10, "a/b/two": 20, "a/three.csv": 5, "a/b/c/_hidden": 1, "top.zip": 7,
    }.items():
        file = tmp_path / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(b"x" * size)
    (tmp_path / "a/empty").mkdir()
    return tmp_path


@pytest.mark.parametrize("levels", [1, 2, 5])
def test_walk_finds_every_file(spark, lake, levels):
    listed = relative_to(walk_files(spark, str(lake), spread_levels=levels), str(lake))
    assert {(r.path, r.size) for r in listed.collect()} == {
        ("/a/b/one.parquet", 10), ("/a/b/two", 20), ("/a/three.csv", 5), ("/a/b/c/_hidden", 1), ("/top.zip", 7),
    }


def test_listing_by_name_and_time(spark, lake):
    listed = walk_files(spark, str(lake), "*.parquet")
    assert [r.size for r in listed.collect()] == [10]
    assert modified_between(listed, "2000-01-01", "2200-01-01").count() == 1
    assert modified_between(listed, "2000-01-01", "2001-01-01").count() == 0


def test_inventories(spark, lake):
    listed = relative_to(walk_files(spark, f"file://{lake}"), f"file://{lake}")
    folders = {r.Path: (r.FolderCount, r.FileCount) for r in inventory.folder_inventory(listed).collect()}
    assert folders == {"/": (1, 1), "/a/": (1, 1), "/a/b/": (1, 2), "/a/b/c/": (0, 1)}
    tree = relative_to(walk_folders(spark, f"file://{lake}"), f"file://{lake}")
    folders = {r.Path: (r.FolderCount, r.FileCount) for r in inventory.folder_inventory(listed, tree).collect()}
    assert folders == {"/": (1, 1), "/a/": (2, 1), "/a/b/": (1, 2), "/a/b/c/": (0, 1), "/a/empty/": (0, 0)}
    sizes = {r.Path: r.TotalBytes for r in inventory.dir_size(listed).collect()}
    assert sizes == {"/": 43, "/a/": 36, "/a/b/": 31, "/a/b/c/": 1}
    types = {r.FileName: r.FileType for r in inventory.file_inventory(listed).collect()}
    assert types["two"] == "orc" and types["three.csv"] == "csv"
    assert inventory.table_count(listed, "/a/").first()[0] == 1


def test_exclusions_with_and_without_slash(spark):
    listing = spark.createDataFrame(
        [("/Test_Validation/x",), ("Test_Validation/y",), ("/data/Test_Validation/z",)], "path string"
    )
    assert [r.path for r in inventory.exclude_results(listing).collect()] == ["/data/Test_Validation/z"]


def test_latest_partition_takes_parts_together(spark):
    listing = spark.createDataFrame([(p,) for p in (
        "/Raw/T/2021/12/31/23/S_T_2021_12_31_23_59.parquet", "/Raw/T/2022/01/01/00/S_T_2022_01_01_00_01.parquet",
        "/Raw/T/2022/01/01/00/S_T_2022_01_01_00_30.parquet", "/Raw/T/readme.txt",
    )], "path string")
    row = inventory.latest_partition(listing).first()
    assert row == ("/Raw/T", "/Raw/T/2022/01/01/00", "*2022_01_01_00_30.parquet")


@pytest.mark.parametrize("folder", ["", "/2022", "/2022/01", "/2022/01/01", "/2022/01/01/09"])
def test_latest_partition_of_every_granularity(spark, folder):
    listing = spark.createDataFrame([(p,) for p in (
        "/Raw/T/2021/12/31/23/S_T_2021_12_31_23_59.csv", f"/Raw/T{folder}/S_T_2022_01_01_09_30.csv", "/Raw/T/2022/02/x_2022_02_01_00_00.parquet",
    )], "path string")
    assert inventory.latest_partition(listing, "csv").first() == ("/Raw/T", f"/Raw/T{folder}", "*2022_01_01_09_30.csv")


def test_files_are_dealt_out_to_many_tasks(spark, tmp_path):
    """Adaptive execution is on; a shuffle of addresses by key alone would end in one partition."""
    for n in range(40):
        (tmp_path / f"d{n}").mkdir()
        (tmp_path / f"d{n}" / "f").write_bytes(b"x" * 30)
    with zipfile.ZipFile(tmp_path / "m.zip", "w") as archive:
        for n in range(30):
            archive.writestr(f"m{n}.tsv", "a\tb\n")

    def tasks(df):
        return len([n for n in df.rdd.glom().map(len).collect() if n])

    listed = walk_files(spark, str(tmp_path))
    assert tasks(listed) > 4
    small = listed.where(F.endswith("path", F.lit("/f")))
    assert tasks(checksums.file_pieces(small, 20)) > 8
    assert tasks(archives.member_lines(listed.where(F.endswith("path", F.lit(".zip"))))) > 3
    plan = small.select(F.col("path").alias("source"), F.concat("path", F.lit(".copy")).alias("target"))
    assert tasks(checksums.copy_files(plan)) > 4


def test_many_small_folders_are_listed_by_few_tasks(spark, tmp_path):
    make_folders(spark.range(2400).select(F.format_string(f"{tmp_path}/%d/x", "id").alias("folder")))
    folders = walk_folders(spark, str(tmp_path), spread_levels=1)
    assert folders.distinct().count() == folders.count() == 1 + 2 * 2400
    assert 40 < folders.rdd.getNumPartitions() <= 400
    assert walk_files(spark, str(tmp_path)).count() == 0


def test_a_tree_is_listed_once(spark, tmp_path):
    def listed(batches):
        for batch in batches:
            (tmp_path / uuid.uuid4().hex).touch()
            yield pd.DataFrame({"path": [f"/d{n % 3}/e/f{n}" for n in batch["id"]]})

    folders = spark.createDataFrame([("/",), ("/none/",)], "path string")
    found = inventory.folder_inventory(spark.range(0, 9, 1, 3).mapInPandas(listed, "path string"), folders).collect()
    assert {tuple(r) for r in found} == {
        ("/", 4, 0), ("/none/", 0, 0), *((f"/d{n}/", 1, 0) for n in range(3)), *((f"/d{n}/e/", 0, 3) for n in range(3)),
    }
    assert len(list(tmp_path.iterdir())) == 3


def test_list_difference_and_completeness(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "t string")
    right = spark.createDataFrame([("a",), ("c",)], "t string")
    assert {tuple(r) for r in inventory.list_difference(left, right, "t").collect()} == {
        ("b", "left_only"), ("c", "right_only"), (None, "left_only"),
    }
    listing = spark.createDataFrame([("/x",), ("/x",)], "path string")
    expected = spark.createDataFrame([("/x",), ("/y",)], "path string")
    labelled = inventory.expected_outputs(expected, listing)
    assert {tuple(r) for r in labelled.collect()} == {("/x", "FileFound"), ("/y", "FileNotFound")}
    assert inventory.all_outputs_present(labelled).first() == (1, False)


def test_zip_members_stream_in_order(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "one.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("hit_data.tsv", "".join(f"{i}\tname {i}\n" for i in range(25_000)))
        archive.writestr("country.tsv", "1\tខ្មែរ\n2\tno newline at end")
        archive.writestr("empty.tsv", "")
    members = {r.member: r.member_size for r in archives.list_members(walk_files(spark, str(tmp_path))).collect()}
    assert set(members) == {"hit_data.tsv", "country.tsv", "empty.tsv"} and members["empty.tsv"] == 0
    lines = archives.member_lines(walk_files(spark, str(tmp_path)), member_suffix="country.tsv")
    assert [r.line for r in lines.orderBy("line_no").collect()] == ["1\tខ្មែរ", "2\tno newline at end"]
    hits = archives.read_zipped_csv(walk_files(spark, str(tmp_path)), "id bigint, name string", member_suffix="hit_data.tsv")
    assert hits.agg(F.count("*"), F.sum("id"), F.max("name")).first() == (25_000, sum(range(25_000)), "name 9999")


def test_zip_members_in_other_dialects(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "one.zip", "w") as archive:
        archive.writestr("a.csv", 'n;t\r\n1;"a ""b"";\nc"\r\n2;\r\nx;y\r\n')
        archive.writestr("b.csv", 't;n\n"só";3\n'.encode("latin-1"))
        archive.writestr("c.csv", 'n\n4\n')
    schema, dialect = "n int, t string", CsvDialect(sep=";", escape='"')
    found = archives.read_zipped_csv(walk_files(spark, str(tmp_path)), schema, dialect, "a.csv")
    assert sorted((str(r.n), r.t) for r in found.collect()) == [("1", 'a "b";\nc'), ("2", None), ("None", "y")]
    found = archives.read_zipped_csv(walk_files(spark, str(tmp_path)), schema, dialect, "b.csv", "latin-1")
    assert [(r.n, r.t) for r in found.collect()] == [(3, "só")]
    found = archives.read_zipped_csv(walk_files(spark, str(tmp_path)), schema, dialect, "c.csv")
    assert [(r.n, r.t) for r in found.collect()] == [(4, None)]


def test_other_row_delimiter(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "d.zip", "w") as archive:
        archive.writestr("m", "a|;b|;c")
    lines = archives.member_lines(walk_files(spark, str(tmp_path)), row_delimiter="|;")
    assert sorted(r.line for r in lines.collect()) == ["a", "b", "c"]


def test_pieces_cover_the_file(spark, tmp_path):
    data = os.urandom(2500)
    (tmp_path / "big.bin").write_bytes(data)
    (tmp_path / "none.bin").write_bytes(b"")
    found = {
        (r.path.rsplit("/", 1)[1], r.piece): (r.piece_bytes, r.sha256)
        for r in checksums.file_pieces(walk_files(spark, str(tmp_path)), piece_bytes=1000).collect()
    }
    assert found == {
        **{("big.bin", i): (len(data[i * 1000:][:1000]), hashlib.sha256(data[i * 1000:][:1000]).hexdigest()) for i in range(3)},
        ("none.bin", 0): (0, hashlib.sha256(b"").hexdigest()),
    }


def test_damaged_copy_is_noticed(spark, tmp_path):
    for side, data in (("a", b"x" * 2500), ("b", b"x" * 1500 + b"y" * 1000)):
        (tmp_path / side).mkdir()
        (tmp_path / side / "f").write_bytes(data)
    sides = [
        checksums.file_pieces(walk_files(spark, str(tmp_path / s)), piece_bytes=1000).withColumn("file", F.lit("f")) for s in "ab"
    ]
    assert checksums.compare_pieces(*sides).first() == ("f", 3, 3, 1)


def test_retention(spark, tmp_path):
    for day in ("2022/01/01", "2022/01/02", "2022/01/09"):
        (tmp_path / "T" / day).mkdir(parents=True)
        (tmp_path / "T" / day / "f.parquet").write_bytes(b"x")
    listing = walk_files(spark, str(tmp_path))
    today = F.lit("2022-01-09").cast("date")
    due = retention_candidates(listing, today)
    assert sorted(r.folder[-10:] for r in due.collect()) == ["2022/01/01", "2022/01/02"]
    exact = retention_candidates(listing, today, exact_day=True)
    assert [r.folder[-10:] for r in exact.collect()] == ["2022/01/02"]
    assert not any(r.deleted for r in delete_folders(due).collect())
    assert (tmp_path / "T/2022/01/01").exists()
    assert all(r.deleted for r in delete_folders(exact, dry_run=False).collect())
    assert not (tmp_path / "T/2022/01/02").exists() and (tmp_path / "T/2022/01/01").exists()


EVENT = "operation int, originalTransaction bigint, bucket int, rowId bigint, currentTransaction bigint, row struct<id: int, v: string>"


def test_transactional_folder(spark, tmp_path):
    base = [(0, 1, 0, i, 1, (i, "old")) for i in range(4)]
    delta = [(1, 1, 0, 1, 2, (1, "new")), (2, 1, 0, 2, 2, None), (1, 1, 0, 1, 3, (1, "newest")), (0, 3, 0, 0, 3, (9, "late"))]
    spark.createDataFrame(base, EVENT).write.orc(f"{tmp_path}/t/base_1")
    spark.createDataFrame(delta, EVENT).write.orc(f"{tmp_path}/t/delta_2_3")
    (tmp_path / "t/base_1/_orc_acid_version").write_text("2")
    events = read_events(spark, f"{tmp_path}/t")
    assert flatten_rows(events).count() == 8
    resolved = {tuple(r) for r in resolve_rows(events).collect()}
    assert resolved == {(0, "old"), (1, "newest"), (3, "old"), (9, "late")}
    dirs = table_dirs(walk_files(spark, str(tmp_path)))
    assert [r.table_dir for r in dirs.collect()] == [f"{tmp_path}/t/base_1/"]


def test_one_large_file_is_copied_by_many_tasks(spark, tmp_path):
    data = os.urandom(100_000)
    (tmp_path / "large").write_bytes(data)
    (tmp_path / "empty").write_bytes(b"")
    (tmp_path / "small").write_bytes(b"abc")
    names = ("large", "empty", "small")
    plan = spark.createDataFrame([(str(tmp_path / n), f"{tmp_path}/out/{n}", os.path.getsize(tmp_path / n)) for n in names], "source string, target string, size bigint")
    copied = {r["target"].rsplit("/", 1)[1]: r["bytes"] for r in checksums.copy_in_blocks(plan, 3000).collect()}
    assert copied == {"large": 100_000, "empty": 0, "small": 3}
    assert sorted(os.listdir(tmp_path / "out")) == sorted(names)
    assert all((tmp_path / "out" / n).read_bytes() == (tmp_path / n).read_bytes() for n in names)


def test_a_join_of_blocks_that_is_repeated(tmp_path):
    blocks = [f"{tmp_path}/t.{k}.block" for k in range(3)]
    for k, block in enumerate(blocks):
        with open(block, "w") as file:
            file.write(str(k) * 3)
    checksums._join_blocks(f"{tmp_path}/t", blocks)
    assert (tmp_path / "t").read_text() == "000111222" and os.listdir(tmp_path) == ["t"]
    checksums._join_blocks(f"{tmp_path}/t", blocks)
    # a task that died after the file was in place and before all its blocks were gone
    with open(blocks[2], "w") as file:
        file.write("222")
    checksums._join_blocks(f"{tmp_path}/t", blocks)
    assert (tmp_path / "t").read_text() == "000111222" and os.listdir(tmp_path) == ["t"]


def test_latest_partition_reads_dates_from_the_end(spark):
    stamp = "2024_05_06_07_08"
    paths = [
        f"/a/2023/2024/01/T_{stamp}.parquet", f"/a/2023/x/T_{stamp}.parquet", f"/a/2023/2024/02/T_2024_02_01_00_00.parquet", f"/b/12024/01/T_{stamp}.parquet",
        f"/c/2024/T_x{stamp}.parquet", "/c/2024/T_2024_05_06_07.parquet", f"/c/2025/{stamp}.csv", f"T_{stamp}.parquet", f"/d/2024/01/02/03/04/{stamp}.parquet",
    ]
    found = sorted(tuple(r) for r in inventory.latest_partition(spark.createDataFrame([(p,) for p in paths], "path string")).collect())
    assert found == [
        ("/a/2023", "/a/2023/2024/02", "*2024_02_01_00_00.parquet"), ("/a/2023/x", "/a/2023/x", f"*{stamp}.parquet"),
        ("/b/12024/01", "/b/12024/01", f"*{stamp}.parquet"), ("/c", "/c/2024", f"*{stamp}.parquet"), ("/d/2024/01/02/03/04", "/d/2024/01/02/03/04", f"*{stamp}.parquet"),
    ]
