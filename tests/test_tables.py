from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tickloom.schemas import schema_for
from tickloom.sources import by_symbol, files, ledger, shape
from tickloom.sources import tables as t
from tickloom.storage import fresh_path, shared_root
from tickloom.workload.tables import new_namespace

PRICES = schema_for("stock_prices")


def bar(symbol, day, close=1.0):
    return (symbol, day, close, close, close, close, 1)


def frame(spark, *bars):
    return spark.createDataFrame(list(bars), PRICES)


def keys(df):
    return sorted((r.symbol, r.trade_date, r.close) for r in df.collect())


def test_shared_folder_is_the_sessions_checkpoint_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is not None:
        assert shared_root(spark) == named.rstrip("/")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_unknown_schema_name():
    with pytest.raises(ValueError):
        schema_for("nothing")


def test_missing_path_reads_empty_but_broken_files_fail(spark):
    path = fresh_path(spark, "files")
    assert files.parquet_or_empty(spark, path, PRICES).schema == PRICES
    assert files.metadata_csv(spark, path).count() == 0
    spark.range(3).write.csv(path)
    with pytest.raises(Exception):
        files.parquet_or_empty(spark, path, PRICES).collect()


def test_missing_table_reads_empty_but_bad_names_fail(spark):
    assert t.table_or_empty(spark, f"{new_namespace(spark)}.none", PRICES).count() == 0
    with pytest.raises(AnalysisException):
        t.table_or_empty(spark, "a.b.c.d", PRICES)


def test_csv_metadata_dates(spark):
    path = fresh_path(spark, "meta")
    spark.createDataFrame(
        [("symbol,last_update,sector",), ("A,2001-01-02 16:00:00,Tech",), ("B,,",), ("C,soon,\"\"",)], "value string"
    ).coalesce(1).write.text(path)
    assert sorted(map(tuple, files.metadata_csv(spark, path).collect())) == [
        ("A", date(2001, 1, 2), "Tech"), ("B", None, None), ("C", None, "")]


def test_csv_tree_takes_kind_and_symbol_from_the_path(spark, tmp_path):
    for kind, symbol in (("stocks", "AB"), ("etfs", "CD")):
        (tmp_path / kind).mkdir()
        text = "Date,Open,High,Low,Close,Volume\n2001-01-02,1,2,0.5,1.5,10\n"
        (tmp_path / kind / f"{symbol}.csv").write_text(text)
    got = files.price_csv_tree(spark, str(tmp_path))
    assert sorted((r.kind, r.symbol, r.close) for r in got.collect()) == [("etfs", "CD", 1.5), ("stocks", "AB", 1.5)]


def test_wide_to_long_skips_absent_tickers_and_empty_rows(spark):
    grid = spark.createDataFrame([(1, 2.0, 5, None), (2, None, None, None)], "d int, A_close double, A_volume int, B_close double")
    got = shape.wide_to_long(grid, ["A", "B", "C"], ["close", "volume"], day="d")
    assert list(map(tuple, got.collect())) == [("A", 1, 2.0, 5)]
    assert shape.wide_to_long(grid, ["C"], ["close"], day="d").count() == 0


def test_enforce_schema_reports_failures(spark):
    raw = spark.createDataFrame([("A", "1"), (None, "x")], "symbol string, n string")
    wanted = StructType.fromDDL("symbol string not null, n int")
    assert sorted(map(tuple, shape.enforce_schema(raw, wanted).collect()), key=repr) == [
        ("A", 1, ""), (None, None, "symbol,n")]
    with pytest.raises(ValueError):
        shape.enforce_schema(raw.drop("n"), wanted)


def test_flatten_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["('Close', 'X')", "('Date', '')", "plain"])
    assert shape.flatten_names(df).columns == ["Close", "Date", "plain"]
    with pytest.raises(ValueError):
        shape.flatten_names(df.toDF("('A', 'X')", "('A', 'Y')", "b"))


def test_price_table_round_trip(spark):
    name = f"{new_namespace(spark)}.p"
    t.create_price_table(spark, name, PRICES)
    t.create_price_table(spark, name, PRICES)  # only if absent
    old, new = bar("A", date(1999, 5, 5)), bar("B", date(2000, 5, 5))
    assert t.append(t.by_month(frame(spark, old, new)), name) == 2
    assert t.append_nonempty(t.by_month(frame(spark)), name) == 0
    assert t.months_in(t.prices(spark, name)) == [199905, 200005]
    plan = t.prices_in_months(spark, name, [200005])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trade_month" in plan
    changed = bar("C", date(2000, 5, 6), 2.0)
    assert t.overwrite_partitions(t.by_month(frame(spark, changed)), name) == 1
    assert keys(t.prices(spark, name)) == [("A", date(1999, 5, 5), 1.0), ("C", date(2000, 5, 6), 2.0)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_replace_table_may_read_the_table_itself(spark):
    name = f"{new_namespace(spark)}.m"
    t.create_table(spark, name, schema_for("metadata"), comment="it's", properties={"k": "v"})
    t.append(spark.createDataFrame([("A", None, "x"), ("B", None, None)], schema_for("metadata")), name)
    assert t.replace_table(spark.table(name).where("sector is not null"), name) == 1
    assert t.replace_table(spark.table(name), name) == 1
    assert [r.symbol for r in spark.table(name).collect()] == ["A"]


def test_failed_replacement_changes_nothing(spark):
    name = f"{new_namespace(spark)}.m"
    t.create_table(spark, name, schema_for("metadata"))
    t.append(spark.createDataFrame([("A", None, "x")], schema_for("metadata")), name)
    broken = spark.table(name).withColumn("sector", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception):
        t.replace_table(broken, name)
    assert spark.table(name).count() == 1


def test_tables_are_listed_and_dropped(spark):
    namespace = new_namespace(spark)
    for name in ("a", "b"):
        t.create_table(spark, f"{namespace}.{name}", schema_for("metadata"))
    t.drop_table(spark, f"{namespace}.a")
    t.drop_table(spark, f"{namespace}.a")
    assert [r.table_name for r in t.list_tables(spark, namespace).collect()] == ["b"]
    assert t.list_catalogs(spark).count() >= 1
    assert namespace in [r[0] for r in t.list_namespaces(spark).collect()]
    with pytest.raises(ValueError):
        t.create_table(spark, f"{namespace}.c", schema_for("metadata"), partitioned_by=["year"])


def test_ledger_order_is_by_commit_time(spark):
    book = f"{new_namespace(spark)}.l"
    ledger.create_ledger(spark, book)
    for hour in (9, 8):
        ledger.record(spark, book, "append", "p", hour, datetime(2001, 1, 2, hour))
    current = ledger.current_snapshot(spark.table(book)).first()
    assert (current.current_snapshot_id, current.snapshots) == (1, 2)


HEADER = "Nasdaq Traded|Symbol|Security Name|Listing Exchange|Market Category|ETF|Round Lot Size|Test Issue|Financial Status|CQS Symbol|NASDAQ Symbol|NextShares"


def test_files_are_read_by_header_name(spark):
    path = fresh_path(spark, "listing")
    lines = [(HEADER,), ("Y|AAA|Aaa Inc.|Q|G|N|100|N|N||AAPL|N",), ("Y|B|Bee|Q|S|Y|x|Y|N||B|N",)]
    spark.createDataFrame(lines, "value string").coalesce(1).write.text(path)
    got = sorted(tuple(r) for r in files.directory_listing(spark, path).collect())
    assert got == [("AAPL", "Aaa Inc.", "G", "N", "N", 100), ("B", "Bee", "S", "Y", "Y", None)]
    short = fresh_path(spark, "short")
    spark.createDataFrame([("symbol,sector",), ("A,x",)], "value string").coalesce(1).write.text(short)
    with pytest.raises(ValueError):
        files.metadata_csv(spark, short)


def test_symbols_in_paths_are_decoded(spark):
    root = fresh_path(spark, "tree")
    one = spark.createDataFrame([("2001-01-02", 2.0, 3.0, 1.0, 1.5, 7)], "Date string, Close double, High double, Low double, Open double, Volume long")
    for name in ("BRK B", "A^A", "C+%20"):
        part = one.withColumn("symbol", F.lit(name))
        part.write.mode("append").partitionBy("symbol").csv(f"{root}/stocks", header=True)
    got = sorted((r.kind, r.symbol, r.open, r.close) for r in files.price_csv_tree(spark, root).collect())
    assert got == [("stocks", s, 1.5, 2.0) for s in ("A^A", "BRK B", "C+%20")]
    one.write.csv(f"{root}/other", header=True)
    with pytest.raises(Exception, match="neither stocks nor etfs"):
        files.price_csv_tree(spark, root).collect()


def test_old_versions_are_deleted_and_lie_beside_the_table(spark):
    name = f"{new_namespace(spark)}.m"
    t.create_table(spark, name, schema_for("metadata"))
    first = t.location_of(spark, name)
    folder = first.rsplit("/", 1)[0]
    for sector in "xy":
        t.replace_table(spark.createDataFrame([("A", None, sector)], schema_for("metadata")), name)
    last = t.location_of(spark, name)
    assert last.rsplit("/", 1)[0] == folder and set(t.table_folders(spark, folder)) == {last.rsplit("/", 1)[1]}


def test_table_folders_skip_what_is_no_table(spark):
    root = fresh_path(spark, "root")
    spark.range(3).write.parquet(f"{root}/a")
    spark.range(3).selectExpr("id", "id AS k").write.partitionBy("k").parquet(f"{root}/b")
    spark.range(3).write.csv(f"{root}/c")
    spark.range(3).write.parquet(f"{root}/_work")
    assert set(t.table_folders(spark, root)) == {"a", "b"}


def loose(spark, *bars):
    """Bars that may lack a symbol or a day."""
    return spark.createDataFrame(list(bars), StructType([StructField(f.name, f.dataType) for f in PRICES]))


def below(path):
    """Every file below a folder but the mark of its last append."""
    return sorted(f.relative_to(path) for f in path.rglob("*") if f.is_file() and f.name.strip(".").split(".")[0] != "_SUCCESS")


def test_append_by_symbol_leaves_one_file_a_symbol_and_append(spark, tmp_path):
    root = tmp_path / "by symbol"
    days = [date(2001, 1, 2), date(2001, 1, 3), None]
    bars = [bar(s, d, float(i)) for i, s in enumerate(["A", "B", "B/C", None]) for d in days]
    for _ in range(2):
        t.append_by_symbol(loose(spark, *bars), str(root))
    t.append_by_symbol(frame(spark, bar("A", days[0], 7.0)), str(root))
    t.append_by_symbol(frame(spark).where("false"), str(root))
    found = below(root)
    assert all(f.suffix == ".parquet" for f in found)  # no checksums, which cost as much as the files
    folders = [f.parent.name for f in found]
    named = ["symbol=A", "symbol=B", "symbol=B%2FC", "symbol=__HIVE_DEFAULT_PARTITION__"]
    assert sorted(set(folders)) == named and len(folders) <= 2 * (len(named) + 3) + 1  # a range may cut a symbol
    assert sorted(f.name for f in root.iterdir()) == ["_SUCCESS", *named]
    got = files.parquet_or_empty(spark, str(root), PRICES).select(*PRICES.names)
    assert sorted(map(str, got.collect())) == sorted(map(str, loose(spark, *bars, *bars, bar("A", days[0], 7.0)).collect()))


def test_append_by_symbol_names_folders_as_spark_does(spark, tmp_path, monkeypatch):
    symbols = [chr(c) for c in [*range(1, 128), 0xE4, 0x20AC, 0x1F600]] + ["", None, "A b", "%41", "__HIVE", ".."]
    rows = loose(spark, *[bar(s, date(2001, 1, 2), float(i)) for i, s in enumerate(symbols)])
    t.append_by_symbol(rows, str(tmp_path / "ours"))
    monkeypatch.setattr(t, "mounted", lambda *_: None)
    t.append_by_symbol(rows, str(tmp_path / "sparks"))
    ours, sparks = ({f.name for f in (tmp_path / name).glob("symbol=*")} for name in ("ours", "sparks"))
    assert ours == sparks and len(ours) == len(symbols) - 1
    got, expected = (files.parquet_or_empty(spark, str(tmp_path / name), PRICES) for name in ("ours", "sparks"))
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_append_by_symbol_cuts_the_rows_of_a_large_symbol(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(by_symbol, "ROW_GROUP", 100_000)
    many = spark.range(40_000).selectExpr(
        "'A' symbol", "date_add(date'1900-01-01', cast(id as int)) trade_date", "id + 0.5D open", "0D high", "0D low", "0D close", "id volume"
    )
    t.append_by_symbol(many, str(tmp_path))
    got = files.parquet_or_empty(spark, str(tmp_path), PRICES).select(*PRICES.names)
    assert got.exceptAll(many).count() == 0 and got.count() == 40_000


def test_failed_append_by_symbol_changes_nothing(spark, tmp_path):
    path, day = str(tmp_path), date(2001, 1, 2)
    t.append_by_symbol(frame(spark, bar("A", day)), path)
    before = below(tmp_path)
    broken = frame(spark, bar("A", day, 2.0), bar("B", day)).withColumn(
        "close", F.when(F.col("symbol") == "B", F.raise_error(F.lit("no such bar")).cast("double")).otherwise(F.col("close"))
    )
    with pytest.raises(Exception, match="no such bar"):
        t.append_by_symbol(broken, path)
    assert below(tmp_path) == before and not list(tmp_path.glob("_append*"))
    (tmp_path / "symbol=C").write_text("a file where a folder should be")
    with pytest.raises(Exception, match="symbol=C"):
        t.append_by_symbol(frame(spark, *[bar(s, day, 2.0) for s in "ABCD"]), path)
    (tmp_path / "symbol=C").unlink()
    assert below(tmp_path) == before and not list(tmp_path.glob("_append*"))
    assert keys(files.parquet_or_empty(spark, path, PRICES)) == [("A", day, 1.0)]


def test_moved_files_are_passed_over_when_a_task_is_repeated(tmp_path):
    source, target = tmp_path / "source", tmp_path / "symbol=A" / "target"
    for _ in range(2):
        if not target.exists():
            source.write_text("rows")
        by_symbol._move(str(source), str(target))
        assert target.read_text() == "rows" and not source.exists()
    with pytest.raises(FileNotFoundError):
        by_symbol._move(str(source), str(tmp_path / "symbol=B" / "target"))
