import gzip
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from remitlens.sources import readers, sinks
from remitlens.sources.claims_adapter import invoice_lines
from remitlens.storage import shared_folder
from remitlens.verification import catalog


def test_load_by_suffix(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "n int, s string")
    sinks.write_csv(df, str(tmp_path / "t.csv"))
    sinks.write_parquet(df, str(tmp_path / "t.parquet"))
    sinks.write_json(df, str(tmp_path / "t.json"))
    for name in ("t.csv", "t.parquet", "t.json"):
        got = readers.load(spark, str(tmp_path / name), "n int, s string")
        assert sorted((r.n, r.s) for r in got.collect()) == [(1, "a,b"), (2, None)]
    assert readers.load(spark, str(tmp_path / "t.csv")).schema["n"].dataType.simpleString() == "string"
    with pytest.raises(ValueError):
        readers.load(spark, str(tmp_path / "t.xlsx"))


def test_first_existing(spark, tmp_path):
    (tmp_path / "b.csv").write_text("x\n1\n")
    missing, there = str(tmp_path / "a.csv"), str(tmp_path / "b*.csv")
    assert readers.first_existing(spark, [missing, there]) == there
    with pytest.raises(FileNotFoundError):
        readers.first_existing(spark, [missing])


def test_latest_snapshot(spark, tmp_path):
    now = time.time()
    for i, name in enumerate(["new_agg_ml.csv", "old_agg_ml.csv", "older_boosted.csv"]):
        (tmp_path / name).write_text(f"x\n{name}\n")
        os.utime(tmp_path / name, (now - 100 * i, now - 100 * i))
    patterns = [str(tmp_path / "*_boosted.csv"), str(tmp_path / "*_agg_ml.csv"), str(tmp_path / "none*.csv")]
    assert [r.x for r in readers.latest_snapshot(spark, patterns).collect()] == ["new_agg_ml.csv"]
    with pytest.raises(FileNotFoundError):
        readers.latest_snapshot(spark, patterns[2:])


def _aged(folder, at):
    for file in folder.rglob("*"):
        os.utime(file, (at, at))


def test_latest_snapshot_of_folders(spark, tmp_path):
    """Tables of several part files, partitioned or not, are read whole."""
    df = spark.range(1000).withColumn("year", 2020 + F.col("id") % 3)
    sinks.write_parquet(df.repartition(4), str(tmp_path / "s0.parquet"))
    sinks.write_parquet(df.where("id < 300").repartition(4), str(tmp_path / "s1.parquet"), partition_by=("year",))
    sinks.write_csv(df.where("id < 500").repartition(4), str(tmp_path / "c0.csv"), compression="gzip")
    sinks.write_tables({"t0": df.where("id < 70").repartition(3)}, str(tmp_path))
    names = {"s0.parquet": 1000, "s1.parquet": 300, "c0.csv": 500, "t0": 70}
    patterns = [str(tmp_path / p) for p in ("s*.parquet", "c*.csv", "t*", "none*")]
    for newest, rows in names.items():
        for name in names:
            _aged(tmp_path / name, 2000 if name == newest else 1000)
        got = readers.latest_snapshot(spark, patterns)
        assert got.count() == rows and set(got.columns) == {"id", "year"}
    # Snapshots of one age: the greatest path.
    assert readers.latest_snapshot(spark, [f"file://{tmp_path}/s*.parquet"]).count() == 300


def test_load_folder_without_suffix(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string")
    sinks.write_tables({"plain": df, "packed": df}, str(tmp_path), compression="gzip")
    sinks.write_json(df, str(tmp_path / "records"))
    sinks.write_parquet(df, str(tmp_path / "table"))
    for name in ("plain", "packed", "records", "table"):
        assert sorted(r.s for r in readers.load(spark, str(tmp_path / name)).collect()) == ["a", "b"]
    assert readers.load(spark, str(tmp_path / "table"), fmt="parquet").count() == 2
    sinks.write_json(df, str(tmp_path / "mixed" / "a"))
    sinks.write_parquet(df, str(tmp_path / "mixed" / "b"))
    for name in ("mixed", "missing"):
        with pytest.raises(ValueError):
            readers.load(spark, str(tmp_path / name))


def test_file_order(spark, tmp_path):
    for i, n in enumerate([3, 4]):
        spark.range(100 * i, 100 * i + n).coalesce(1).write.parquet(str(tmp_path / f"p{i}"))
    one = readers.with_file_order(spark.read.parquet(str(tmp_path / "p1"))).orderBy("id").collect()
    assert [(r.id, r.row_id) for r in one] == [(100, 0), (101, 1), (102, 2), (103, 3)]
    both = readers.with_file_order(spark.read.parquet(str(tmp_path / "p0"), str(tmp_path / "p1"))).orderBy("row_id").collect()
    assert [r.row_id for r in both] == list(range(7))
    ids = [r.id for r in both]
    assert ids == [0, 1, 2, 100, 101, 102, 103]


def _csv_folder(path, files, newline="\n"):
    path.mkdir()
    for name, lines in files.items():
        (path / name).write_bytes(newline.join(lines).encode())
    return str(path)


@pytest.fixture
def small_ranges(spark):
    """Byte ranges of a few lines, so that one file is many of them."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("broadcast", [True, False])
def test_csv_rows_in_order(spark, tmp_path, small_ranges, monkeypatch, newline, broadcast):
    monkeypatch.setattr(readers, "BROADCAST_RANGES", 10**6 if broadcast else 0)
    head = '"Amount*",Lab (copy),"a,b"'
    files, want = {}, []
    for k, n in enumerate([40, 0, 1, 300]):
        rows = [(f"{k}.{i}", None if i % 3 else f"t{'é' * (i % 5)}", f'x "{i}", y') for i in range(n)]
        lines = [f'{a},{b or ""},"{c.replace(chr(34), chr(34) * 2)}"' for a, b, c in rows]
        files[f"part-{k}.csv"] = [head, *(x for line in lines for x in ([line, "", "  "] if k == 0 else [line]))]
        want += rows
    path = _csv_folder(tmp_path / "in", files, newline)
    lines = readers.read_csv_in_order(spark, path)
    assert lines.columns == ["Amount*", "Lab (copy)", "a,b", "row_id"]
    got = sorted(tuple(r) for r in lines.collect())
    assert sorted(r[3] for r in got) == list(range(len(want)))
    assert [r[:3] for r in sorted(got, key=lambda r: r[3])] == want


def test_csv_order_with_schema(spark, tmp_path):
    path = _csv_folder(tmp_path / "in", {"b.csv": ["n,s", "3,c"], "a.csv": ["n,s", "1,a", "x,b", "2"]})
    schema = StructType([StructField("n", IntegerType()), StructField("s", StringType())])
    got = readers.read_csv_in_order(spark, path, schema, name="at").orderBy("at").collect()
    assert [tuple(r) for r in got] == [(1, "a", 0), (None, "b", 1), (2, None, 2), (3, "c", 3)]
    with pytest.raises(ValueError, match="schema"):
        readers.read_csv_in_order(spark, path, StructType([StructField("s", StringType())]))


def test_csv_order_refuses_what_it_cannot_number(spark, tmp_path, small_ranges):
    records = [f'{i},"line {i}\nline two, ""quoted"""' if i % 4 == 0 else f"{i},plain" for i in range(60)]
    path = _csv_folder(tmp_path / "broken", {"a.csv": ["n,s", *records], "b.csv": ["n,s", "99,last"]})
    with pytest.raises(ValueError, match="multi_line"):
        readers.read_csv_in_order(spark, path)
    got = readers.read_csv_in_order(spark, path, multi_line=True).orderBy("row_id").collect()
    assert [int(r.n) for r in got] == [*range(60), 99] and [r.row_id for r in got] == list(range(61))
    assert got[0].s == 'line 0\nline two, "quoted"'
    for files in ({"a.csv": ["n,s", "1,a"], "b.csv": ["s,n", "a,1"]}, {"a.csv": ["n,n", "1,a"]}, {"a.csv": [""]}):
        with pytest.raises(ValueError):
            readers.read_csv_in_order(spark, _csv_folder(tmp_path / str(len(list(tmp_path.iterdir()))), files))


def test_csv_files_follow_the_number_of_rows(spark, tmp_path, monkeypatch):
    """No task sorts more than some rows, however many there are; the reader finds the same order again."""
    monkeypatch.setattr(sinks, "ROWS_PER_FILE", 50)
    df = spark.range(0, 1000, 1, 3).select((F.col("id") * 617 % 1000).alias("row_id"))
    df = df.withColumn("text", F.concat(F.lit(' "'), F.col("row_id").cast("string"), F.lit('", ')))
    at = str(tmp_path / "in")
    sinks.write_csv_in_order(df, at, "row_id", 1000, least=6)
    sizes = [r["count"] for r in spark.read.option("header", True).csv(at).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) >= 18 and max(sizes) <= 100
    got = sorted(tuple(r) for r in readers.read_csv_in_order(spark, at, name="at").select("at", "text").collect())
    assert got == [(i, f' "{i}", ') for i in range(1000)]
    sinks.write_csv_in_order(df, str(tmp_path / "few"), "row_id", 1, least=6)
    assert len(list((tmp_path / "few").glob("*.csv"))) == 6


def test_csv_report_is_not_sorted_in_a_fixed_number_of_tasks(spark, tables, monkeypatch):
    monkeypatch.setattr(sinks, "ROWS_PER_FILE", 300)
    rows = catalog._report_as_csv(spark, tables)
    assert len(rows.select("row_id").distinct().collect()) == rows.count() == 6000
    (at,) = [f for f in os.listdir(shared_folder(spark)) if f.startswith("report-") and len([x for x in os.listdir(f"{shared_folder(spark)}/{f}") if x.endswith(".csv")]) > 15]


def test_csv_header_is_found_by_offsets(spark, tmp_path):
    lines = spark.createDataFrame([("f", 0, k, v) for k, v in ((3, "a,b"), (4, "1,2"))], "_file string, _block long, _at long, value string")
    offsets = readers._offsets(lines, headers=True)
    assert readers._header(lines, offsets) == ["a", "b"]


def test_deliverables(spark, tmp_path):
    df = spark.createDataFrame([(["a", "b"], 1.5)], "cpt_list array<string>, x double").coalesce(1)
    sinks.write_tables({"one": df, "two": df.withColumn("x", F.lit(2))}, str(tmp_path / "out"), compression="gzip")
    (part,) = (tmp_path / "out" / "one").glob("*.csv.gz")
    assert gzip.decompress(part.read_bytes()).decode().split() == ["cpt_list,x", '"[\'a\',', "'b']\",1.5"]
    assert len(list((tmp_path / "out" / "two").glob("*.csv.gz"))) == 1
    sinks.write_text(spark.createDataFrame([(2, "b"), (1, "a")], "n int, text string"), str(tmp_path / "text"))
    lines = "".join(p.read_text() for p in sorted((tmp_path / "text").glob("part*")))
    assert lines == "1. a\n2. b\n"
    schema = "invoice_number string, payer string, group_em string, group_em2 string, cpt_code string"
    rows = spark.createDataFrame([("i", "p", "g", "h", "c"), ("i", None, "g", "h", "c")], schema)
    sinks.write_with_rejects(rows, str(tmp_path / "good"), str(tmp_path / "bad"))
    assert spark.read.parquet(str(tmp_path / "good")).count() == 1
    assert readers.read_csv(spark, str(tmp_path / "bad")).count() == 1


def test_deliveries_are_seen_whole(spark, tmp_path):
    """A writer that dies between tables, or before its commit record, changes nothing for readers."""
    folder = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        readers.published(spark, folder, "one")
    first = spark.createDataFrame([(0.25, "a")], "collection_rate double, payer string")
    sinks.publish({"one": first, "two": first}, folder, compression="gzip")
    broken = first.select(F.raise_error(F.lit("the writer dies")).cast("double").alias("collection_rate"), "payer")
    with pytest.raises(Exception, match="the writer dies"):
        sinks.publish({"one": first.withColumn("payer", F.lit("b")), "two": broken}, folder)
    (tmp_path / "out" / "commits" / "000000009-dead" / "_temporary").mkdir(parents=True)
    for name in ("one", "two"):
        got = readers.published(spark, folder, name)
        assert got.columns == ["Collection_Rate", "Payer"] and [tuple(r) for r in got.collect()] == [("25%", "a")]
    sinks.publish({"one": first.withColumn("payer", F.lit("c"))}, folder, display=False)
    assert [tuple(r) for r in readers.published(spark, folder, "one", "collection_rate double, payer string").collect()] == [(0.25, "c")]
    assert [r["number"] for r in sorted(readers.commits(spark, folder))] == [1, 2]
    with pytest.raises(FileNotFoundError):
        readers.published(spark, folder, "two")


def test_orphan_lines_stay(spark, tables, tmp_path):
    for name in ("orders", "customer", "part"):
        spark.read.parquet(f"{tables}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    items = spark.read.parquet(f"{tables}/lineitem.parquet").limit(50)
    orphan = items.limit(1).withColumns({"l_orderkey": F.lit(-1).cast("bigint"), "l_partkey": F.lit(-1).cast("bigint")})
    items.unionByName(orphan).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    lines = invoice_lines(spark, str(tmp_path))
    (lone,) = lines.where("invoice_number = '-1'").collect()
    assert lines.count() == 51 and lone.payer is None and lone.year is None and lone.charge_amount is not None
