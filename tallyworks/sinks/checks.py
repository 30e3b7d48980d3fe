"""Checks at the write: numbers are observed while the rows are written to a stage, and a failed check stops the swap."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyworks.session import scratch_dir


@dataclass(frozen=True)
class Expect:
    """What a result must hold: no nulls in some columns, no key twice, enough rows, and at most so many rows of a kind.

    ``most`` gives the largest number of rows for which a condition, as SQL text, may be true.
    """

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    least_rows: int = 0
    most: dict[str, int] = field(default_factory=dict)


class CheckFailed(ValueError):
    """The rows are not what was expected; ``report`` has the observed numbers."""

    def __init__(self, failed: Sequence[str], report: dict) -> None:
        super().__init__("; ".join(failed))
        self.report = report


def write_checked(df: DataFrame, write: Callable[[DataFrame], int], expect: Expect, parts: Sequence[str] = ()) -> dict:
    """Stage ``df``, check the numbers that were observed on the way, then let ``write`` put it in place.

    Row, null and condition counts come from the staging write itself; repeated keys and the rows of each partition
    of ``parts`` from one aggregation each of the staged table, pre-aggregated before the shuffle. Returns the report; raises
    ``CheckFailed`` before anything is replaced.
    """
    observation = Observation()
    conditions = list(expect.most)
    counted = df.observe(
        observation,
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in expect.not_null],
        *[F.count_if(F.expr(c)).alias(f"kind_{k}") for k, c in enumerate(conditions)],
    )
    path = scratch_dir(df.sparkSession, "checked")
    counted.write.parquet(path)
    seen = observation.get
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    report = {
        "rows": seen["rows"],
        "nulls": {c: seen[f"null_{c}"] for c in expect.not_null},
        "kinds": {c: seen[f"kind_{k}"] for k, c in enumerate(conditions)},
        "repeated_keys": repeated_keys(staged, expect.unique) if expect.unique else 0,
        "partitions": {tuple(r)[:-1]: r["count"] for r in staged.groupBy(*parts).count().collect()} if parts else {},
    }
    failed = [f"{n} rows without {c}" for c, n in report["nulls"].items() if n]
    failed += [f"{n} rows with {c}, {expect.most[c]} at most" for c, n in report["kinds"].items() if n > expect.most[c]]
    if report["repeated_keys"]:
        failed.append(f"{report['repeated_keys']} keys {', '.join(expect.unique)} more than once")
    if report["rows"] < expect.least_rows:
        failed.append(f"{report['rows']} rows, {expect.least_rows} at least")
    if failed:
        raise CheckFailed(failed, report)
    report["written"] = write(staged)
    return report


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> int:
    """How many keys several rows have; nulls are a key like any other."""
    return df.groupBy(*keys).count().filter("count > 1").agg(F.count(F.lit(1))).first()[0]
