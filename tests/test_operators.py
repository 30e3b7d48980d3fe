"""Generic operators against brute force, with one key or instant holding a third of the rows."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import (
    HotSplit,
    asof_lookup,
    boundary_row,
    hot_key_cuts,
    interval_vwap,
    keep_latest_ties,
    latest_per_key,
    rolling_sum,
    spread_over_slices,
    trailing_count,
)

START = dt.datetime(2024, 1, 2, 14, 0, 0)
ALWAYS_HOT = HotSplit(share=0.05, floor=10)


def at(seconds: float) -> dt.datetime:
    return START + dt.timedelta(seconds=seconds)


def skewed_rows(n: int, seed: int, same_instant: bool):
    """(key, second, id, amount); key 0 has over a third of the rows."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if rng.random() < 0.4 else rng.randrange(1, 9)
        second = 30 if same_instant and key == 0 else rng.randrange(0, 600)
        rows.append((None if key == 8 else key, at(second), f"u{rng.randrange(10**6)}-{i}", rng.randrange(1, 100)))
    return rows


def brute_rolling(rows, preceding):
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    result = {}
    for group in groups.values():
        group.sort(key=lambda r: (r[1], r[2]))
        for i, row in enumerate(group):
            result[row[2]] = sum(r[3] for r in group[max(0, i - preceding) : i + 1])
    return result


@pytest.mark.parametrize("same_instant", [False, True])
@pytest.mark.parametrize("preceding", [1, 10, 40])
def test_rolling_sum_over_slices(spark, same_instant, preceding):
    rows = skewed_rows(900, preceding, same_instant)
    df = spark.createDataFrame(rows, "k int, ts timestamp, id string, amount long")
    cuts = hot_key_cuts(df, ["k"], ["ts", "id"], ALWAYS_HOT)
    hot = {r["_k_k"]: len(r["_cuts"]) for r in cuts.collect()}
    assert hot[0] > 1
    result = rolling_sum(df, ["k"], ["ts", "id"], "amount", preceding, "s", cuts)
    assert result.filter("k = 0").select("_slice").distinct().count() > 2
    got = {r["id"]: r["s"] for r in result.collect()}
    assert result.count() == len(rows)
    assert got == brute_rolling(rows, preceding)


def test_no_hot_key_means_no_slices(spark):
    df = spark.createDataFrame(skewed_rows(50, 1, False), "k int, ts timestamp, id string, amount long")
    assert hot_key_cuts(df, ["k"], ["ts", "id"], HotSplit()) is None
    assert "_slice" not in rolling_sum(df, ["k"], ["ts", "id"], "amount", 3, "s").columns


def test_the_number_of_hot_keys_is_bounded():
    with pytest.raises(ValueError):
        HotSplit(share=0.0)


def test_dimension_rows_reach_every_slice(spark):
    df = spark.createDataFrame(skewed_rows(600, 3, False), "k int, ts timestamp, id string, amount long")
    cuts = hot_key_cuts(df, ["k"], ["ts", "id"], ALWAYS_HOT)
    rolled = rolling_sum(df, ["k"], ["ts", "id"], "amount", 10, "s", cuts)
    dim = spark.createDataFrame([(k, f"name{k}") for k in range(20)], "k int, name string")
    joined = rolled.join(spread_over_slices(dim, ["k"], cuts), ["k", "_slice"], "left")
    assert joined.count() == df.count()
    assert joined.filter("k is not null and (name is null or name <> concat('name', k))").count() == 0


@pytest.mark.parametrize("same_instant", [False, True])
def test_trailing_count(spark, same_instant):
    rows = skewed_rows(400, 5, same_instant)
    df = spark.createDataFrame(rows, "k int, ts timestamp, id string, amount long").filter("k is not null")
    got = {(r["k"], r["_second"]): r["n"] for r in trailing_count(df, "k", "ts", "id", 60, "n").collect()}
    for key, moment, _, _ in rows:
        if key is None:
            continue
        second = int(moment.replace(tzinfo=dt.timezone.utc).timestamp())
        expected = sum(r[0] == key and 0 <= (moment - r[1]).total_seconds() <= 60 for r in rows)
        assert got[(key, second)] == expected


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (1, 7, "c"), (2, None, "d")], "k int, t int, v string")
    latest = latest_per_key(df, ["k"], [F.col("t").desc(), F.col("v").desc()])
    assert {tuple(r) for r in latest.collect()} == {(1, 7, "c"), (2, None, "d")}
    before_shuffle = latest._jdf.queryExecution().executedPlan().toString().split("Exchange")[-1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_keep_latest_ties(spark):
    data = [(1, 5, "a"), (1, 7, "b"), (1, 7, "c"), (2, None, "d"), (None, 3, "e"), (None, 2, "f")]
    df = spark.createDataFrame(data, "k int, t int, v string")
    assert {r["v"] for r in keep_latest_ties(df, ["k"], "t").collect()} == {"b", "c", "e"}


@pytest.mark.parametrize("which, expected", [("first", 10), ("last", 40)])
def test_boundary_row(spark, which, expected):
    df = spark.createDataFrame([(1, 2, 20), (1, 1, 30), (1, 1, 10), (1, 9, 40)], "k int, t int, v int")
    row = df.groupBy("k").agg(boundary_row(("v",), ("t",), which).alias("b")).first()
    assert row["b"]["v"] == expected


def ticks(n: int, seed: int, fraction: bool = False):
    """(id, key, time, value, size): key 0 and one of its instants are crowded."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if rng.random() < 0.5 else rng.randrange(1, 4)
        second = 700 if key == 0 and rng.random() < 0.6 else rng.randrange(0, 2400)
        second += rng.randrange(4) / 4 if fraction else 0
        rows.append((i, key, at(second), rng.randrange(100, 999) / 100, rng.randrange(1, 50)))
    return rows


def orders(n: int, seed: int):
    """(order, key, start, end): many share the start; some are empty, open or of no known key."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if rng.random() < 0.5 else rng.randrange(1, 6)
        start = 700 if rng.random() < 0.4 else rng.randrange(-100, 2600)
        end = None if rng.random() < 0.1 else start + rng.randrange(-50, 1200)
        rows.append((i, None if i % 29 == 0 else key, at(start), None if end is None else at(end)))
    return rows


@pytest.mark.parametrize("lookback, bin_seconds", [(600, 60), (45, 60), (600, 7), (90, 600)])
def test_asof_lookup(spark, lookback, bin_seconds):
    quotes, left = ticks(700, lookback, fraction=True), orders(200, bin_seconds)
    quote_df = spark.createDataFrame(quotes, "id long, k int, qt timestamp, bid double, size int")
    left_df = spark.createDataFrame(left, "o int, k int, a timestamp, b timestamp")
    result = asof_lookup(
        left_df,
        quote_df,
        keys=["o"],
        by="k",
        targets={"a": "a", "b": "b"},
        right_ts="qt",
        payload=["bid"],
        tie_break=["id"],
        lookback_seconds=lookback,
        bin_seconds=bin_seconds,
    )
    got = {r["o"]: r for r in result.collect()}
    assert len(got) == result.count()
    for order, key, *moments in left:
        for name, moment in zip("ab", moments):
            hits = [
                q for q in quotes
                if moment is not None and q[1] == key and 0 <= (moment - q[2]).total_seconds() <= lookback
            ]
            best = max(hits, key=lambda q: (q[2], q[0]), default=None)
            row = got.get(order)
            found = None if row is None else (row[f"{name}_bid"], row[f"{name}_qt"])
            expected = (None, None) if best is None else (best[3], best[2])
            assert (found or (None, None)) == expected


@pytest.mark.parametrize("bin_seconds", [60, 7, 3600])
def test_interval_vwap(spark, bin_seconds):
    trades, left = ticks(700, 3), orders(200, bin_seconds)
    trade_df = spark.createDataFrame(trades, "id long, k int, tt timestamp, price double, size int")
    left_df = spark.createDataFrame(left, "o int, k int, a timestamp, b timestamp")
    result = interval_vwap(
        left_df,
        trade_df,
        keys=["o"],
        by="k",
        start="a",
        end="b",
        right_ts="tt",
        price="price",
        size="size",
        volume_out="volume",
        vwap_out="vwap",
        bin_seconds=bin_seconds,
    )
    assert result.schema["volume"].dataType.simpleString() == "bigint"
    got = {r["o"]: r for r in result.collect()}
    for order, key, start, end in left:
        inside = [t for t in trades if end is not None and t[1] == key and start <= t[2] <= end]
        row = got.get(order)
        if not inside:
            assert row is None or (row["volume"] is None and row["vwap"] is None)
            continue
        volume = sum(t[4] for t in inside)
        assert row["volume"] == volume
        assert row["vwap"] == pytest.approx(sum(t[3] * t[4] for t in inside) / volume, rel=1e-12)
        assert min(t[3] for t in inside) - 1e-9 <= row["vwap"] <= max(t[3] for t in inside) + 1e-9


def test_interval_without_sizes_or_prices(spark):
    left = spark.createDataFrame([(1, 1, at(0), at(9)), (2, 2, at(0), at(9)), (3, 3, at(0), at(9))], "o int, k int, a timestamp, b timestamp")
    rows = [(1, at(1), 5.0, None), (2, at(1), None, 4), (3, at(1), 5.0, 0)]
    trades = spark.createDataFrame(rows, "k int, tt timestamp, price double, size int")
    result = interval_vwap(
        left, trades, keys=["o"], by="k", start="a", end="b", right_ts="tt", price="price", size="size",
        volume_out="volume", vwap_out="vwap",
    )
    assert {tuple(r) for r in result.collect()} == {(1, None, None), (2, 4, None), (3, 0, None)}


def vwap_of(spark, rows, intervals, kind):
    trades = spark.createDataFrame(rows, f"k int, tt timestamp, price {kind}, size {kind}")
    left = spark.createDataFrame(intervals, "o int, k int, a timestamp, b timestamp")
    result = interval_vwap(
        left, trades, keys=["o"], by="k", start="a", end="b", right_ts="tt", price="price", size="size",
        volume_out="volume", vwap_out="vwap",
    )
    return {r["o"]: (r["volume"], r["vwap"]) for r in result.collect()}


def test_interval_vwap_keeps_small_trades_next_to_large_ones(spark):
    rng = random.Random(11)
    spread = (10**6, 2 * 86_400 * 10**6)
    when = [at(rng.randrange(spread[i % 2]) / 1e6 - 5) for i in range(400)]
    rows = [(1, t, round(10 ** rng.uniform(-6, 4), 8), 10 ** rng.uniform(-9, 9)) for t in when]
    ends = sorted(rng.choices(when, k=200)) + [at(rng.uniform(-9, 9)) for _ in range(100)]
    intervals = [(i, 1, *sorted(rng.sample(ends, 2))) for i in range(200)] + [(200 + i, 1, t, t) for i, t in enumerate(when[:50])]
    got = vwap_of(spark, rows, intervals, "double")
    for order, _, a, b in intervals:
        inside = [(p, s) for _, t, p, s in rows if a <= t <= b]
        volume, vwap = got[order]
        if not inside:
            assert (volume, vwap) == (None, None)
            continue
        assert volume == pytest.approx(sum(s for _, s in inside), rel=1e-12)
        assert vwap == pytest.approx(sum(p * s for p, s in inside) / sum(s for _, s in inside), rel=1e-12)
        assert min(p for p, _ in inside) * (1 - 1e-12) <= vwap <= max(p for p, _ in inside) * (1 + 1e-12)


def test_interval_vwap_with_nan_and_decimals(spark):
    rows = [(1, at(1), float("nan"), 1.0), (1, at(2), 4e-11, 4e-7), (1, at(2 * 86_400), 5.0, 2.0)]
    intervals = [(1, 1, at(0), at(3)), (2, 1, at(2), at(3)), (3, 1, at(2), at(3 * 86_400)), (4, 1, at(-9 * 86_400), at(9 * 86_400))]
    got = vwap_of(spark, rows, intervals, "double")
    assert got[1][1] != got[1][1] and got[4][1] != got[4][1]
    assert (got[2][0], got[3][0]) == (4e-7, pytest.approx(2.0000004)) and got[2][1] == pytest.approx(4e-11, rel=1e-12)
    exact = [(1, at(i), Decimal("1.00000001"), Decimal("0.00000001") if i % 2 else Decimal("123456789.00000003")) for i in range(0, 200, 7)]
    volume, _ = vwap_of(spark, exact, [(1, 1, at(0), at(200))], "decimal(18,8)")[1]
    assert volume == sum(r[3] for r in exact)


def test_interval_before_the_epoch_and_across_it(spark):
    rows = [(1, dt.datetime(1969, 12, 31, 23, 59, 59), 1.0, 1.0), (1, dt.datetime(1970, 1, 1, 0, 0, 1), 3.0, 1.0), (1, dt.datetime(1960, 1, 1), 5.0, 1.0)]
    intervals = [(1, 1, rows[0][1], rows[1][1]), (2, 1, rows[2][1], rows[1][1]), (3, 1, rows[2][1], rows[0][1])]
    assert vwap_of(spark, rows, intervals, "double") == {1: (2.0, 2.0), 2: (3.0, 3.0), 3: (2.0, 3.0)}
