from __future__ import annotations

from datetime import date

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.operators import dimensions as d
from tickloom.operators import enrich, quality
from tickloom.operators import relational as r
from tickloom.operators.positions import with_position, with_position_in

BARS = "symbol string, trade_date date, open double, high double, low double, close double, volume bigint"
META = "symbol string, last_update date, sector string"
RUN = date(2001, 1, 2)


def bar(symbol, day, close=1.0, volume=1):
    return (symbol, day, close, close, close, close, volume)


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns or df.columns).collect()), key=repr)


# -- positions ---------------------------------------------------------------


def test_positions_are_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    got = with_position(df.repartition(7), "v").toPandas().sort_values("v")
    assert got.position.tolist() == list(range(1, 1001))


def test_positions_in_groups_with_one_hot_group(spark):
    df = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("g"), "id"
    )
    got = with_position_in(df, ["g"], "id").toPandas()
    assert sorted(got[got.g == "hot"].position) == list(range(1, 301))
    assert sorted(got[got.g.isna()].position) == list(range(1, 301))
    assert set(got[~got.g.isin(["hot"]) & got.g.notna()].position) == {1}


def test_positions_of_nothing(spark):
    assert with_position(spark.range(0), "id").count() == 0


# -- relational --------------------------------------------------------------


def test_known_symbol_without_date_is_not_stale(spark):
    listing = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "symbol string")
    meta = spark.createDataFrame([("A", None, ""), ("B", date(2001, 1, 1), ""), ("C", RUN, "")], META)
    assert rows(r.stale_or_unseen(listing, meta, RUN)) == [("B",), ("D",)]


def test_clean_rows_keeps_partly_filled_rows(spark):
    day = date(2000, 1, 1)
    df = spark.createDataFrame(
        [("A", day, None, None, None, None, None), ("B", day, None, None, None, 2.0, None),
         ("C", None, 1.0, 1.0, 1.0, 1.0, 1), ("D", day, float("nan"), None, None, None, None)], BARS)
    assert rows(r.clean_rows(df), "symbol") == [("B",)]


def test_missing_and_present_sector_split_everything(spark):
    meta = spark.createDataFrame([("A", None, None), ("B", None, ""), ("C", None, "Tech")], META)
    assert rows(r.missing_sector(meta), "symbol") == [("A",), ("B",)]
    assert rows(r.with_sector(meta), "symbol") == [("C",)]


def test_new_bars_keeps_repeats_and_null_dates(spark):
    day = date(2000, 1, 1)
    batch = spark.createDataFrame([bar("A", day), bar("B", day), bar("B", day), bar("C", None)], BARS)
    stored = spark.createDataFrame([bar("A", day)], BARS)
    assert rows(r.new_bars(batch, stored), "symbol") == [("B",), ("B",), ("C",)]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from("ABCDEF")), st.sets(st.sampled_from("ABCXYZ")))
def test_known_and_new_together_are_the_batch(spark, batch, known):
    left = spark.createDataFrame([(s,) for s in batch], "symbol string")
    right = spark.createDataFrame([(s,) for s in known], "symbol string")
    existing, new = r.split_known(left, right)
    assert rows(existing.unionByName(new)) == sorted((s,) for s in batch)
    assert {s for (s,) in rows(existing)} <= known


def test_null_profile_lists_only_columns_with_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, None), (None, 3)], "a int, b int")
    assert rows(r.null_profile(df)) == [("a", 1), ("b", 2)]
    assert rows(r.null_profile(df.where("a is not null").select("a"))) == []


def test_latest_per_symbol_keeps_a_known_sector(spark):
    df = spark.createDataFrame(
        [("A", date(2000, 1, 1), "Tech"), ("A", RUN, None), ("B", None, "")], META
    )
    assert rows(r.latest_per_symbol(df)) == [("A", RUN, "Tech"), ("B", None, None)]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.sampled_from("ABCD"), st.sampled_from(["Tech", "", None])),
       st.dictionaries(st.sampled_from("ABCD"), st.sampled_from(["Energy", "", None])))
def test_backfill_never_loses_a_sector(spark, known, found):
    meta = spark.createDataFrame([(s, None, v) for s, v in known.items()], META)
    more = spark.createDataFrame(list(found.items()), "symbol string, sector string")
    got = {s: v for s, _, v in rows(r.backfill_sector(meta, more))}
    assert got == {s: found.get(s) or v for s, v in known.items()}


def test_request_plan_splits_a_large_period(spark):
    symbols = spark.range(130).select(
        F.format_string("S%03d", "id").alias("symbol"),
        F.when(F.col("id") % 13 == 0, F.lit(RUN)).when(F.col("id") == 1, F.lit(date(2000, 12, 30))).alias("last_update"),
    )
    plan = r.request_plan(symbols, RUN, size=50).toPandas()
    largest = plan[plan.period == "max"].sort_values("request_no")
    assert largest.symbol_count.tolist() == [50, 50, 19]
    assert sorted(sum(map(list, largest.symbols), [])) == sum(map(list, largest.symbols), [])
    assert plan[plan.period == "3d"].symbols.map(list).tolist() == [["S001"]]


def test_batches_have_the_asked_size(spark):
    symbols = spark.range(250).select(F.col("id").cast("string").alias("symbol"))
    sizes = r.batch_assignment(symbols, 100).groupBy("batch_id").count().orderBy("batch_id").toPandas()
    assert sizes["count"].tolist() == [100, 100, 50]


# -- dimensions --------------------------------------------------------------


def test_new_ids_continue_and_are_stable(spark):
    days = spark.createDataFrame([(7, date(2000, 1, 3))], "date_id int, trade_date date")
    bars = spark.createDataFrame([bar("A", date(2000, 1, n)) for n in (5, 3, 4, 5)] + [bar("A", None)], BARS)
    want = [(8, date(2000, 1, 4)), (9, date(2000, 1, 5))]
    assert rows(d.new_trading_days(bars, days)) == want
    assert rows(d.new_trading_days(bars.repartition(5), days)) == want
    assert rows(d.new_trading_days(bars, days.where("false")))[0] == (1, date(2000, 1, 3))


def test_facts_are_routed_by_kind(spark):
    day = date(2000, 1, 1)
    symbols = spark.createDataFrame([(1, "A", False), (2, "E", True)], "symbol_id int, symbol string, is_etf boolean")
    days = spark.createDataFrame([(1, day)], "date_id int, trade_date date")
    keyed = d.fact_keys(spark.createDataFrame([bar("A", day), bar("E", day), bar("X", day)], BARS), symbols, days)
    assert keyed.count() == 3
    assert rows(d.fact_rows(keyed, False), "symbol_id", "date_id") == [(1, 1)]
    assert rows(d.fact_rows(keyed, True), "symbol_id", "date_id") == [(2, 1)]


def test_dedupe_prefers_the_fullest_bar(spark):
    day = date(2000, 1, 1)
    bars = spark.createDataFrame([("A", day, None, None, None, 9.0, None), bar("A", day, 2.0), bar("A", day, 2.0)], BARS)
    assert rows(d.dedupe_bars(bars)) == [bar("A", day, 2.0)]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.integers(1, 9), st.floats(0, 9)), st.dictionaries(st.integers(1, 9), st.floats(0, 9)))
def test_upsert_leaves_one_row_per_key(spark, old, new):
    schema = "k int, v double"
    stored, changes = (spark.createDataFrame(list(x.items()), schema) for x in (old, new))
    assert dict(rows(d.upsert(stored, changes, ["k"]))) == {**old, **new}
    assert dict(rows(d.keep_existing(stored, changes, ["k"]))) == {**new, **old}


def test_last_listing_wins(spark):
    listing = spark.createDataFrame([("A", "old", 1), ("A", "new", 2), ("B", None, 1)], "symbol string, name string, at int")
    assert rows(d.replace_metadata(listing, "at")) == [("A", "new"), ("B", None)]


def test_last_update_moves_only_with_complete_data(spark):
    meta = spark.createDataFrame([(s, d_, None) for s, d_ in
                                  [("OK", date(2001, 1, 1)), ("GAP", date(2001, 1, 1)), ("NEW", None), ("IDLE", None)]], META)
    done = spark.createDataFrame([("OK", True), ("GAP", False), ("NEW", False)], "symbol string, is_complete boolean")
    assert rows(d.advance_last_update(meta, done, RUN), "symbol", "last_update") == sorted(
        [("OK", RUN), ("GAP", date(2001, 1, 1)), ("NEW", RUN), ("IDLE", None)], key=repr)


# -- quality -----------------------------------------------------------------


def test_first_failing_rule_is_the_reason(spark):
    days = [date(2000, 1, n) for n in (1, 2, 3)]
    data = []
    for symbol, closes, volumes, order in [
        ("GOOD", [1, 1, 1], [1, 1, 1], [0, 1, 2]),
        ("PRICE", [1, 0, 1], [-1, 1, 1], [2, 1, 0]),
        ("VOLUME", [1, 1, 1], [1, -1, 1], [2, 1, 0]),
        ("ORDER", [1, 1, 1], [1, 1, 1], [0, 2, 1]),
    ]:
        data += [(*bar(symbol, days[order[i]], float(closes[i]), volumes[i]), i) for i in range(3)]
    data.append((*bar("EMPTY", days[0])[:5], None, 1, 0))
    got = rows(quality.validate_prices(spark.createDataFrame(data, BARS + ", seq int")), "symbol", "valid_rows", "reason")
    assert got == sorted([("GOOD", 3, None), ("PRICE", 3, quality.BAD_PRICE), ("VOLUME", 3, quality.BAD_VOLUME),
                          ("ORDER", 3, quality.BAD_ORDER), ("EMPTY", 0, quality.NO_ROWS)], key=repr)


def test_order_is_checked_across_blocks_of_arrivals(spark, monkeypatch):
    monkeypatch.setattr(quality, "ARRIVALS_PER_BLOCK", 2)
    steps = {"UP": range(1, 8), "FALL": [1, 2, 4, 3, 5, 6, 7], "BORDER": [1, 5, 6, 2, 7, 8, 9]}
    data = [(*bar(s, date(2000, 1, n)), i) for s, ns in steps.items() for i, n in enumerate(ns)]
    got = dict(rows(quality.validate_prices(spark.createDataFrame(data, BARS + ", seq int")), "symbol", "is_valid"))
    assert got == {"UP": True, "FALL": False, "BORDER": False}


def test_directory_must_have_rows_and_columns(spark):
    schema = "symbol string, security_name string, market_category string, etf string, round_lot_size int"
    listing = spark.createDataFrame([("A", "a", "Q", "N", 1), ("B", "b", "Q", " ", 1)], schema)
    assert rows(quality.validate_directory(listing), "symbol") == [("A",)]
    for broken in (listing.drop("etf"), listing.where("false")):
        with pytest.raises(ValueError):
            quality.validate_directory(broken)


def test_completeness(spark):
    day = date(2000, 1, 1)
    bars = spark.createDataFrame([bar("A", day), ("B", day, None, 1.0, 1.0, 1.0, 1), bar("C", date(2000, 1, 2))], BARS)
    got = dict(rows(quality.completeness(bars, F.lit(day)), "symbol", "is_complete"))
    assert got == {"A": True, "B": False, "C": False}


def test_calendar_skips_weekends_and_holidays(spark):
    holidays = spark.createDataFrame([(date(2001, 1, 1),)], "holiday date")
    days = quality.trading_calendar(spark, date(2000, 12, 29), date(2001, 1, 3), holidays)
    assert rows(days) == [(date(2000, 12, 29),), (date(2001, 1, 2),), (date(2001, 1, 3),)]
    asked = spark.createDataFrame([(date(2001, 1, 1),), (date(2001, 1, 2),)], "trade_date date")
    assert rows(quality.is_trading_day(asked, days)) == [(date(2001, 1, 1), False), (date(2001, 1, 2), True)]


def test_staleness(spark):
    ledger = spark.createDataFrame([(date(2000, 12, 30),), (date(2000, 12, 1),)], "committed_at date")
    assert rows(quality.staleness_gate(ledger, RUN)) == [(3, True)]
    assert rows(quality.staleness_gate(ledger.where("false"), RUN)) == [(1, False)]


def test_integrity_report(spark):
    bars = spark.createDataFrame([bar("A", RUN), bar("A", RUN), bar("B", None), bar("B", RUN)], BARS)
    known = spark.createDataFrame([("A",)], "symbol string")
    got = dict(rows(quality.integrity_report(bars, ["symbol", "trade_date"], ["trade_date"], {"symbol": known})))
    assert got == {"repeated key symbol, trade_date": 1, "null in trade_date": 1, "orphan symbol": 2}


# -- enrichment --------------------------------------------------------------


def test_landing_fetch_takes_only_later_rows(spark):
    landing = spark.createDataFrame(
        [("a", date(2000, 1, 1)), (" a", RUN), ("b", date(2000, 1, 1)), ("c", RUN)], "symbol string, dt date")
    wanted = spark.createDataFrame([("A", date(2001, 1, 1)), ("B", None), ("C", RUN)], "symbol string, last_update date")
    assert rows(enrich.landing_fetch(wanted, landing, RUN), "symbol") == [(" a",), ("b",)]


def test_batches_retry_and_report_failures(spark):
    def fetch(asked: pd.DataFrame) -> pd.DataFrame:
        if "S1" in set(asked.symbol):
            raise ConnectionError("down")
        return asked.iloc[1:].assign(size=len(asked))

    symbols = spark.createDataFrame([(f"S{i}",) for i in range(5)], "symbol string")
    out = enrich.batched_map(symbols, fetch, StructType.fromDDL("symbol string, size bigint"), size=2, attempts=2)
    assert rows(out, "symbol", "size", "batch_id", "status", "attempts") == sorted(
        [("S0", None, 0, "failed", 2), ("S1", None, 0, "failed", 2), ("S3", 2, 1, "ok", 1)], key=repr)
