"""Versions at a time, backdated updates, restated balances, profiles from moments and checked writes."""

import datetime as dt
import itertools
import random
from collections import defaultdict
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tallyworks import jobs, schemas
from tallyworks.operators import valid_at
from tallyworks.plans import balances, fraud, ledger, scd2
from tallyworks.sinks import CheckFailed, Expect, write_checked
from tests.conftest import plan_of, ts

DAY = dt.date(2024, 1, 2)
MOMENT = dt.datetime(2024, 1, 2)


# ---- versions at a time


def test_valid_at_against_every_pair(spark):
    rng = random.Random(4)
    moments = [MOMENT + dt.timedelta(minutes=rng.randrange(3000), microseconds=rng.randrange(3)) for _ in range(400)]
    facts = [(k, rng.choice(["hot", "hot", "a", "b", "none", None]), rng.choice([*moments, None])) for k in range(600)]
    versions = []
    for key in ("hot", "a", "b", "unused", None):
        cuts = sorted(rng.sample(moments, 12))
        for k, (start, end) in enumerate(zip(cuts, cuts[1:])):
            if k % 4 != 3:  # gaps
                versions.append((key, None if key == "a" and k == 0 else start, end, f"{key}{k}"))
        versions.append((key, cuts[-1], None, f"{key} last"))
    df = spark.createDataFrame(facts, "id int, who string, at timestamp")
    history = spark.createDataFrame(versions, "who string, start timestamp, end timestamp, name string")
    for seconds in (60, 3600, 10**6):
        found = valid_at(df, history, key="who", at="at", start="start", end="end", columns=["name"], bin_seconds=seconds)
        assert found.columns == ["id", "who", "at", "name"]
        got = {r["id"]: r["name"] for r in found.collect()}
        assert len(got) == found.count() == len(facts)
        for k, who, at in facts:
            holds = [n for w, a, b, n in versions if None not in (who, at) and w == who and (a is None or a <= at) and (b is None or at < b)]
            assert [got[k]] == (holds or [None])
    empty = valid_at(df, history.limit(0), key="who", at="at", start="start", end="end", columns=["name"])
    assert empty.filter("name IS NOT NULL").count() == 0 and empty.count() == len(facts)
    assert valid_at(df.limit(0), history, key="who", at="at", start="start", end="end", columns=["name"]).count() == 0


def test_valid_at_of_overlapping_versions_takes_the_one_begun_last(spark):
    facts = spark.createDataFrame([(1, "k", MOMENT)], "id int, who string, at timestamp")
    early, late = MOMENT - dt.timedelta(days=2), MOMENT - dt.timedelta(days=1)
    rows = [("k", early, None, "early"), ("k", late, MOMENT, "ends now"), ("k", late, None, "late")]
    history = spark.createDataFrame(rows, "who string, start timestamp, end timestamp, name string")
    assert valid_at(facts, history, key="who", at="at", start="start", end="end", columns=["name"]).first()["name"] == "late"


def test_the_ledger_as_of_joins_nothing_by_range(spark, small):
    from checks.queries import BUILDERS, Inputs

    plan = plan_of(BUILDERS["ledger_enrich_as_of"](Inputs(spark, small)))
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and not [line for line in joins if "effective_" in line or "_end" in line or "_instant" in line]


# ---- backdated updates

ATTRIBUTES = ("first_name", "last_name", "email_address", "phone_number", "residential_address", "marital_status")
UPDATE = "customer_id string, first_name string, last_name string, email_address string, phone_number string, residential_address string, marital_status string, update_ts timestamp, seq int"


def update(customer, name, when, seq=0, first="F"):
    return (customer, first, name, None, None, "x", None, ts(when), seq)


def version(key, customer, name, start, end="9999-12-31 23:59:59", active=True):
    return (key, customer, "F", name, None, None, "x", None, ts(start), ts(end), active)


def lines(df):
    return sorted((r.customer_id, r.last_name, str(r.effective_start_date), str(r.effective_end_date), r.is_active, r.first_name) for r in df.collect())


def stored(spark, df):
    return spark.createDataFrame(df.collect(), schemas.CUSTOMER_SCD2)


@pytest.fixture(scope="module")
def history(spark):
    rows = [
        version("s1", "c", "A", "2024-01-01 00:00:00", "2024-01-06 00:00:00", False),
        version("s2", "c", "B", "2024-01-06 00:00:00"),
        version("g1", "gap", "A", "2024-01-01 00:00:00", "2024-01-04 00:00:00", False),
        version("g2", "gap", "A", "2024-01-08 00:00:00"),
        version("u1", "untouched", "A", "2024-01-01 00:00:00", "2024-01-03 00:00:00", False),
        version("u2", "untouched", "A", "2024-01-03 00:00:00"),
    ]
    return spark.createDataFrame(rows, schemas.CUSTOMER_SCD2)


UPDATES = [
    update("c", "L", "2024-01-03 10:00:00", 1),
    update("c", "A", "2024-01-03 10:00:00", 0),  # loses the tie
    update("c", "L", "2024-01-04 09:00:00", first="other"),  # tells nothing new
    update("c", "B", "2024-01-05 09:00:00"),
    update("c", "B", "2024-01-09 09:00:00"),
    update("gap", "A", "2024-01-06 00:00:00"),
    update("new", "N", "2024-01-05 00:00:00"),
    update("new", "M", "2024-01-02 23:59:59"),
    update(None, "lost", "2024-01-05 00:00:00"),
]


def test_updates_split_and_merge_versions(spark, history):
    daily = scd2.updates_by_day(spark.createDataFrame(UPDATES, UPDATE), tie_break=["seq"])
    found = scd2.scd2_backdated(history, daily)
    assert found.columns == schemas.CUSTOMER_SCD2.names
    day = "2024-01-0{} 00:00:00".format
    end = "9999-12-31 23:59:59"
    assert lines(found) == sorted(
        [
            ("c", "A", day(1), day(3), False, "F"),
            ("c", "L", day(3), day(5), False, "F"),
            ("c", "B", day(5), day(6), False, "F"),
            ("c", "B", day(6), end, True, "F"),
            ("gap", "A", day(1), day(4), False, "F"),
            ("gap", "A", day(6), day(8), False, "F"),
            ("gap", "A", day(8), end, True, "F"),
            ("new", "M", day(2), day(5), False, "F"),
            ("new", "N", day(5), end, True, "F"),
            ("untouched", "A", day(1), day(3), False, "F"),
            ("untouched", "A", day(3), end, True, "F"),
        ]
    )
    keys = {r.effective_start_date: r.customer_surrogate_key for r in found.filter("customer_id = 'c'").collect()}
    assert keys[ts(day(1))] == "s1" and keys[ts(day(6))] == "s2" and len(set(keys.values())) == 4
    same = scd2.scd2_backdated(history, daily.limit(0))
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, history.collect()))


def test_any_order_of_days_gives_one_history(spark, history):
    rng = random.Random(1)
    rows = [update(c, rng.choice("AB"), f"2024-01-0{d} 08:00:00") for c in ("c", "gap", "new", "u") for d in (2, 3, 5, 6, 7) if rng.random() < 0.8]
    days = sorted({r[7].date() for r in rows})
    landed = lambda some: spark.createDataFrame([r for r in rows if r[7].date() in some], UPDATE)
    wanted = lines(scd2.scd2_backdated(history, scd2.updates_by_day(landed(days))))
    for order in rng.sample(list(itertools.permutations(days)), 4):
        current, known = history, set()
        for day in order:  # from the late day on, all updates that have landed are read
            known.add(day)
            current = stored(spark, scd2.scd2_backdated(current, scd2.updates_by_day(landed(known), day)))
        assert lines(current) == wanted
    spans = defaultdict(list)
    for customer, _, start, end, _, _ in wanted:
        spans[customer].append((start, end))
    for own in spans.values():
        own.sort()
        assert all(a[1] <= b[0] for a, b in zip(own, own[1:]))


def test_days_in_order_equal_the_daily_job(spark):
    rng = random.Random(7)
    rows = [update(f"c{k % 6}", rng.choice("ABC"), f"2024-01-0{1 + k % 7} 08:00:00", k) for k in range(60)]
    updates = spark.createDataFrame(rows, UPDATE)
    start = spark.createDataFrame([version(f"s{k}", f"c{k}", "A", "2020-01-01 00:00:00") for k in range(0, 6, 2)], schemas.CUSTOMER_SCD2)
    step = start
    for d in range(1, 8):
        run = dt.date(2024, 1, d)
        changes = scd2.scd2_changes(step, scd2.updates_of_day(updates, run, tie_break=["seq"]))
        step = stored(spark, scd2.scd2_apply(step, changes, run))
    once = scd2.scd2_backdated(start, scd2.updates_by_day(updates, tie_break=["seq"]))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, step.collect()))


def test_backdating_shuffles_the_history_once(spark, tmp_path, history):
    history.write.parquet(str(tmp_path / "history"))
    spark.createDataFrame(UPDATES, UPDATE).write.parquet(str(tmp_path / "updates"))
    daily = scd2.updates_by_day(spark.read.parquet(str(tmp_path / "updates")))
    plan = plan_of(scd2.scd2_backdated(spark.read.parquet(str(tmp_path / "history")), daily))
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan  # updates by customer and day, then everything


def test_a_bucketed_history_is_not_shuffled(spark, tmp_path, history):
    from tallyworks.sinks import Buckets, overwrite_table_partitions, replace_table

    place = str(tmp_path / "history")
    name = "history_in_buckets"
    buckets = Buckets("customer_id", 4)
    replace_table(history, name, [], "parquet", place, buckets)
    try:
        updates = spark.createDataFrame(UPDATES, UPDATE).filter("customer_id IS NOT NULL").dropDuplicates(["customer_id"])
        changes = scd2.scd2_changes(spark.table(name), updates)
        rows = sorted(map(str, changes.collect()))
        assert rows == sorted(map(str, scd2.scd2_changes(history, updates).collect()))
        lines_ = plan_of(scd2.scd2_changes(spark.table(name), updates)).splitlines()
        scan = next(k for k, line in enumerate(lines_) if "FileScan parquet" in line)
        depth = lambda line: len(line) - len(line.lstrip(" :+-"))
        above, level = [], depth(lines_[scan])
        for line in reversed(lines_[:scan]):
            if depth(line) < level:
                above.append(line)
                level = depth(line)
        assert any("Join" in x for x in above) and not any("Exchange" in x for x in above)
        overwrite_table_partitions(history.filter("is_active"), name, [], buckets)
        assert spark.table(name).count() == 3
        assert len(list((tmp_path / "history").glob("part-*.parquet"))) <= 4
    finally:
        spark.sql(f"DROP TABLE {name}")


# ---- restated balances


def fact(day, source, dest, amount, kind="PAYMENT"):
    return (dt.date(2024, 1, day), source, dest, kind, Decimal(amount))


FACTS = "trx_date date, source_account_id string, destination_account_id string, transaction_type string, amount_base_currency decimal(18,4)"
ACCOUNTS = "account_id string, customer_id string, account_type string, open_date date, currency_code string, status string, region_code string"


@pytest.mark.parametrize("seed", [1, 2])
def test_restatement_equals_a_run_of_all_days(spark, seed):
    rng = random.Random(seed)
    names = [f"a{k}" for k in range(12)]
    accounts = spark.createDataFrame(
        [(n, n, rng.choice(["SAVINGS", "CHECKING"]), DAY, "USD", "CLOSED" if n == "a3" else "OPEN", rng.choice(["EU", "US", None])) for n in names], ACCOUNTS
    )
    rows = [fact(rng.randrange(1, 7), rng.choice([*names, "?", None]), rng.choice([*names, None]), rng.randrange(1, 500), rng.choice(["PAYMENT", "FEE", "REVERSAL_CREDIT", None])) for _ in range(120)]
    late = [r for r in rows if rng.random() < 0.15 and r[0].day >= 3]
    early = [r for r in rows if r not in late]
    missing = {("a1", 4), ("a2", 5)}  # accounts without a snapshot on a day

    def chain(facts):
        before = spark.createDataFrame([("a0", dt.date(2023, 12, 31), Decimal(100))], "account_id string, balance_date date, ending_balance decimal(18,4)")
        out = []
        for d in range(1, 7):
            day = dt.date(2024, 1, d)
            present = accounts.filter(~F.col("account_id").isin([a for a, x in missing if x == d]))
            movements = balances.daily_movements(spark.createDataFrame(facts, FACTS), day, null_accounts=False)
            found = balances.eod_balances(present, before, movements, day, MOMENT)
            found = spark.createDataFrame(found.collect(), found.schema)
            out.append(found)
            before = found
        whole = out[0]
        for x in out[1:]:
            whole = whole.unionByName(x)
        return whole

    snapshots, wanted = chain(early), chain(rows)
    moved = balances.late_movements(spark.createDataFrame(late, FACTS))
    restated = balances.restated_balances(snapshots, moved, MOMENT, accounts=accounts)
    old = {(r.account_id, r.balance_date): tuple(r) for r in snapshots.collect()}
    new = {(r.account_id, r.balance_date): tuple(r) for r in restated.collect()}
    assert {k for k, v in new.items() if v == old[k]} == set()
    assert old | new == {(r.account_id, r.balance_date): tuple(r) for r in wanted.collect()}
    places = {(r.balance_date, r.region_code) for r in restated.collect()}
    replaced = balances.replaced_partitions(snapshots, restated).collect()
    assert {(r.account_id, r.balance_date): tuple(r) for r in replaced} == {k: v for k, v in (old | new).items() if (v[-2], v[-1]) in places}
    none = balances.late_movements(spark.createDataFrame([], FACTS))
    assert balances.restated_balances(snapshots, none, accounts=accounts).count() == 0
    assert balances.replaced_partitions(snapshots, restated.limit(0)).count() == 0


def test_restatement_reads_touched_partitions_only(spark, tmp_path):
    names = spark.range(100).select(
        F.col("id").cast("string").alias("account_id"), F.lit("c").alias("customer_id"), F.lit("SAVINGS").alias("account_type"), F.lit(DAY).alias("open_date"),
        F.lit("USD").alias("currency_code"), F.lit("OPEN").alias("status"), F.when(F.col("id") < 10, "EU").otherwise("US").alias("region_code"),
    )
    days = []
    for d in range(1, 9):
        none = balances.daily_movements(spark.createDataFrame([], FACTS), DAY, null_accounts=False)
        days.append(balances.eod_balances(names, spark.createDataFrame([], "account_id string, balance_date date, ending_balance decimal(18,4)"), none, dt.date(2024, 1, d), MOMENT))
    path = str(tmp_path / "snapshots")
    for x in days:
        x.write.mode("append").partitionBy("balance_date", "region_code").parquet(path)
    snapshots = spark.read.schema(days[0].schema).parquet(path)
    late = balances.late_movements(spark.createDataFrame([fact(7, "3", "5", 10)], FACTS))
    restated = balances.restated_balances(snapshots, late, MOMENT, accounts=names)
    rows = restated.collect()
    assert sorted((r.account_id, r.balance_date.day, int(r.beginning_balance), int(r.ending_balance)) for r in rows) == [
        ("3", 7, 0, -10), ("3", 8, -10, -10), ("5", 7, 0, 10), ("5", 8, 10, 10),
    ]
    from tests.test_plan_shapes import _nodes

    scans = [n for n in _nodes(spark, restated._jdf.queryExecution().executedPlan()) if n.nodeName().startswith("Scan parquet")]
    assert [n.metrics().apply("numOutputRows").value() for n in scans] == [20]  # two days of one region


def test_unposted_movements(spark):
    accounts = spark.createDataFrame([("a", "x", "s", DAY, "USD", "OPEN", None), ("b", "x", "s", DAY, "USD", "CLOSED", None), ("n", "x", "s", DAY, "USD", None, None)], ACCOUNTS)
    movements = spark.createDataFrame([("a", 1, 2), ("b", 3, 4), ("?", 5, 6), (None, 7, 8), ("n", 9, 9)], "account_id string, total_credits int, total_debits int")
    assert {tuple(r) for r in balances.unposted_movements(accounts, movements).collect()} == {
        ("b", 3, 4, "CLOSED"), ("?", 5, 6, "UNKNOWN"), (None, 7, 8, "UNKNOWN"), ("n", 9, 9, "NONE"),
    }


# ---- profiles from moments


def card(k, account, amount, day, when="10:00:00"):
    return (f"t{k}" if k % 7 else None, account, "m", amount, ts(f"{day} {when}"), day)


def test_profiles_from_moments(spark):
    rng = random.Random(2)
    days = [dt.date(2023, 10, 1) + dt.timedelta(days=k) for k in range(95)]
    rows = [card(k, rng.choice(["big", "small", "both"]), None, rng.choice(days)) for k in range(900)]
    amount = {"big": lambda: 1e9 + rng.choice([-1, 0, 1]), "small": lambda: rng.random(), "both": lambda: rng.choice([1e9, 1e-3])}
    rows = [(a, b, c, amount[b]() if rng.random() < 0.97 else None, d, e) for a, b, c, _, d, e in rows]
    rows += [card(1, "one", 5.0, days[50]), card(1, "none", None, days[50]), card(1, "old", 5.0, dt.date(2020, 1, 1))]
    trx = spark.createDataFrame(rows, schemas.CC_TRANSACTIONS)
    run = days[-1]
    merged = {r.account_id: r for r in fraud.profile_from_moments(fraud.daily_moments(trx), run).collect()}
    whole = {r.account_id: r for r in fraud.account_profile(trx, run).collect()}
    assert merged.keys() == whole.keys() == {"big", "small", "both", "one", "none"}
    for name, other in whole.items():
        for a, b in zip(merged[name][1:], other[1:]):
            # the scan's own deviation is off by 1e-8 for amounts of 1e9
            assert (a is None and b is None) or a == pytest.approx(b, rel=1e-7 if name == "big" else 1e-9, abs=1e-9)
    period = [Fraction(r[3]) for r in rows if r[1] == "big" and r[3] is not None and run - dt.timedelta(days=90) <= r[5] < run]
    mean = sum(period) / len(period)
    exact = float(sum((x - mean) ** 2 for x in period) / (len(period) - 1)) ** 0.5
    assert merged["big"].stddev_trx_amount_90d == pytest.approx(exact, rel=1e-9)
    assert 0.5 < merged["big"].stddev_trx_amount_90d < 1.0
    halves = fraud.daily_moments(trx.filter("amount < 5")).union(fraud.daily_moments(trx.filter("amount >= 5 OR amount IS NULL")))
    parts = {r.account_id: r for r in fraud.profile_from_moments(halves, run).collect()}
    assert all(parts[n].stddev_trx_amount_90d == pytest.approx(whole[n].stddev_trx_amount_90d, rel=1e-7, abs=1e-9) for n in whole)


def test_scores_with_moments_read_the_day_and_the_hour_before(spark, tmp_path):
    yesterday = DAY - dt.timedelta(days=1)
    rows = [card(k, "a", 5.0, yesterday, "23:30:00") for k in range(1, 5)] + [card(9, "a", 5.0, yesterday, "22:00:00")]
    rows += [card(22 + k, "a", 5.0, DAY, when) for k, when in enumerate(["00:10:00", "00:40:00"])] + [card(30, "a", 9.0, dt.date(2023, 12, 1))]
    path = str(tmp_path / "cards")
    spark.createDataFrame(rows, schemas.CC_TRANSACTIONS).write.partitionBy("trx_date").parquet(path)
    trx = spark.read.schema(schemas.CC_TRANSACTIONS).parquet(path)
    accounts = spark.createDataFrame([("a", 50.0, 0.0)], "account_id string, home_lat double, home_lon double")
    merchants = spark.createDataFrame([("m", 50.0, 0.0)], schemas.DIM_MERCHANTS)
    counts = lambda **more: sorted(r.trx_last_hour_cnt for r in fraud.fraud_scores(trx, accounts, merchants, DAY, **more).collect())
    assert counts() == [1, 2] and counts(context=fraud.hour_before(trx, DAY)) == [2, 5]
    fraud.daily_moments(trx).write.parquet(str(tmp_path / "moments"))
    moments = spark.read.parquet(str(tmp_path / "moments"))
    df = fraud.fraud_scores(trx, accounts, merchants, DAY, moments=moments)
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, fraud.fraud_scores(trx, accounts, merchants, DAY).collect()))
    from tests.test_plan_shapes import _nodes

    scans = [n for n in _nodes(spark, df._jdf.queryExecution().executedPlan()) if n.nodeName().startswith("Scan parquet") and "numFiles" in str(n.metrics().keys())]
    assert max(n.metrics().apply("numOutputRows").value() for n in scans) <= 3  # the day's two facts; three days of moments


# ---- sketches


def test_sketches_merge_over_days(spark):
    rows = spark.range(60_000).select(
        (F.col("id") % 3).cast("string").alias("customer_id"), F.date_add(F.lit(DAY), (F.col("id") % 7).cast("int")).alias("trx_date"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 20_000).when(F.col("id") % 3 == 1, F.col("id") % 50).alias("destination_account_id"),
    )
    sketches = ledger.destination_sketches(rows)
    found = {r.customer_id: r.distinct_destinations for r in ledger.distinct_destinations(sketches, DAY, DAY + dt.timedelta(days=6)).collect()}
    exact = {r.customer_id: r.n for r in rows.groupBy("customer_id").agg(F.count_distinct("destination_account_id").alias("n")).collect()}
    assert exact["0"] > 6_000 and exact["2"] == 0
    for name, n in exact.items():
        assert abs(found[name] - n) <= 0.02 * n
    assert ledger.distinct_destinations(sketches, dt.date(2020, 1, 1), dt.date(2020, 1, 2)).count() == 0


def test_sketches_of_few_destinations_are_exact(spark):
    """The two destinations of each account have the same 26-bit place of an HLL sketch."""
    pairs = [(1875, 40602), (6107, 49625), (545, 36580), (15471, 41876), (9552, 12647)]
    rows = [(str(k), DAY + dt.timedelta(days=j), there) for k, pair in enumerate(pairs) for j in (0, 1) for there in pair]
    sketches = ledger.destination_sketches(spark.createDataFrame(rows, "customer_id string, trx_date date, destination_account_id long"))
    found = ledger.distinct_destinations(sketches, DAY, DAY + dt.timedelta(days=1)).collect()
    assert [r.distinct_destinations for r in found] == [2] * 5


def test_sketches_of_many_destinations_are_exact(spark):
    """More destinations than a sketch of the default size of Spark's functions holds, so the union must not cut them."""
    rows = spark.range(100_000).select(
        F.lit("a").alias("customer_id"), F.date_add(F.lit(DAY), (F.col("id") % 5).cast("int")).alias("trx_date"), (F.col("id") % 90_000).alias("destination_account_id")
    )
    found = ledger.distinct_destinations(ledger.destination_sketches(rows), DAY, DAY + dt.timedelta(days=4)).first()
    assert found.distinct_destinations == 90_000


# ---- checked writes


def test_a_failed_check_stops_the_write(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("b", 4)], "name string, n int")
    written = []

    def write(staged):
        written.append(staged.count())
        return written[-1]

    report = write_checked(rows, write, Expect(most={"n > 2": 2}), ["name"])
    assert report == {"rows": 4, "nulls": {}, "kinds": {"n > 2": 2}, "repeated_keys": 0, "partitions": {("a",): 1, ("b",): 2, (None,): 1}, "written": 4}
    for expect, words in (
        (Expect(not_null=("name",)), "1 rows without name"),
        (Expect(unique=("name",)), "1 keys name more than once"),
        (Expect(least_rows=5), "4 rows, 5 at least"),
        (Expect(most={"n > 2": 1}), "2 rows with n > 2, 1 at most"),
    ):
        with pytest.raises(CheckFailed, match=words) as caught:
            write_checked(rows, write, expect)
        assert caught.value.report["rows"] == 4
    assert written == [4]
    assert write_checked(rows.limit(0), write, Expect(unique=("name",)))["rows"] == 0


# ---- jobs


@pytest.fixture
def tables(spark):
    def save(df, name, parts=()):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
        df.write.mode("overwrite").partitionBy(*parts).saveAsTable(name)

    yield save
    spark.sql("DROP DATABASE IF EXISTS late_core CASCADE")


def test_backfill_job(spark, tables, history):
    tables(history, "late_core.history")
    rows = [(r[0], *r[1:7], r[7]) for r in UPDATES]
    names = ", ".join(f"{c} string" for c in ("customer_id", *ATTRIBUTES)) + ", timestamp timestamp"
    tables(spark.createDataFrame(rows, names), "late_core.updates")
    for _ in range(2):
        done = jobs.run_customer_backfill(spark, DAY, updates="late_core.updates", history="late_core.history")
        assert done["written"] == spark.table("late_core.history").count() and done["rejected"] == 1
    active = spark.table("late_core.history").filter("is_active")
    assert active.count() == active.select("customer_id").distinct().count() == 4


def test_restatement_job(spark, tables):
    accounts = spark.createDataFrame([("a", "c", "SAVINGS", DAY, "USD", "OPEN", "EU"), ("b", "c", "SAVINGS", DAY, "USD", "OPEN", None)], ACCOUNTS)
    tables(accounts, "late_core.accounts")
    tables(spark.createDataFrame([fact(2, "a", "b", 10)], FACTS), "late_core.facts")
    names = dict(accounts="late_core.accounts", target="late_core.balances", as_of_ts=MOMENT)
    for d in (2, 3):
        jobs.run_daily_balances(spark, dt.date(2024, 1, d), facts="late_core.facts", **names)
    tables(spark.createDataFrame([fact(2, "b", "?", 4)], FACTS), "late_core.late")
    assert jobs.run_balance_restatement(spark, late="late_core.late", **names) == 2
    got = {(r.account_id, r.balance_date.day): int(r.ending_balance) for r in spark.table("late_core.balances").collect()}
    assert got == {("a", 2): -10, ("a", 3): -10, ("b", 2): 6, ("b", 3): 6}


def test_moments_job(spark, tables):
    rows = [card(k, "a", float(k), DAY) for k in range(1, 5)]
    tables(spark.createDataFrame(rows, schemas.CC_TRANSACTIONS), "late_core.cards")
    for _ in range(2):
        assert jobs.run_account_moments(spark, DAY, trx="late_core.cards", target="late_core.moments") == 1
    row = spark.table("late_core.moments").first()
    assert (row.n_amounts, row.whole_sum, row.rest_sum, row.trx_date) == (4, 10.0, 0.0, DAY) and row.squared_deviations == pytest.approx(5.0)
