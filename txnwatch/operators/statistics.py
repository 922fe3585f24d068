"""Feature statistics kept as mergeable daily parts, so that a refit needs no raw rows for them.

Rows are added once, as they arrive, under a name of their own (a batch, a day, a file).
What is kept of them are log-amount moments per day and category, and counts per day,
user and country. Both merge exactly, so a state over any run of whole days comes from
the parts alone; only a day that is cut needs its raw rows.

An addition writes a folder of its own and then, last, one marker. Readers take the
newest marker of a name, so an addition that stopped half-way is not seen, and one that
is repeated replaces what it was. ``compact`` merges all additions into one; their names
are kept beside it, and an addition whose name is among them is already counted and left
out. One writer per folder.

Cases: rows without a time are in no day and left out; null categories, users, countries
and amounts count as in :func:`fit_features`; an empty addition has a marker and no rows.
"""

import uuid
from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from txnwatch.operators.features import (
    FeatureState, merged_counts, merged_moments, moments_and_counts, state_from,
)
from txnwatch.operators.ordering import value_at
from txnwatch.session import materialize, require_utc
from txnwatch.streaming.runs import Runs

MARKER = "name string, attempt string, version long, is_merged boolean"
MOMENTS = "day int, merchant_category string, n long, n_amount long, mean double, variance double"
COUNTRIES = "day int, user_id string, country string, n long"
TABLES = {"moments": (MOMENTS, "merchant_category"), "countries": (COUNTRIES, "user_id")}
_MERGED = "merged"


def day_of(time_column: str = "event_time"):
    """Days since 1970 in UTC."""
    return F.unix_date(F.col(time_column).cast("date"))


class DailyStatistics:
    def __init__(self, spark: SparkSession, root: str):
        require_utc(spark)
        self.spark, self.root = spark, root
        self._log = Runs(spark, f"{root}/markers", MARKER)

    def add(self, rows: DataFrame, name: str) -> bool:
        """Count ``rows`` under ``name``; false, and nothing done, if a merge holds that name already."""
        merged, _ = self._visible()
        if merged and self.spark.read.schema("name string").parquet(f"{self.root}/{merged}/names").filter(F.col("name") == name).take(1):
            return False
        timed = rows.filter(F.col("event_time").isNotNull()).withColumn("day", day_of())
        self._write(name, *moments_and_counts(timed, "day"), merged=False)
        return True

    def compact(self) -> int:
        """Merge all additions into one; how many there were beside the last merge."""
        merged, additions = self._visible()
        if not additions:
            return 0
        names = self.spark.createDataFrame([(name,) for name in additions], "name string")
        if merged:
            names = names.unionAll(self.spark.read.schema("name string").parquet(f"{self.root}/{merged}/names"))
        self._write(_MERGED, merged_moments(self._read("moments"), "day"), merged_counts(self._read("countries"), "day"), merged=True, names=names)
        return len(additions)

    def _write(self, name, moments, countries, merged: bool, names: DataFrame | None = None) -> None:
        attempt = uuid.uuid4().hex
        for table, rows in (("moments", moments), ("countries", countries)):
            schema, key = TABLES[table]
            columns = [part.split()[0] for part in schema.split(", ")]
            # In order of days, so that a scan from some day on skips the files before it. A range shuffle looks at its
            # input twice; that of an addition is stored already.
            rows = materialize(rows.select(*columns), f"daily-{table}") if merged else rows.select(*columns)
            rows.repartitionByRange("day", key).sortWithinPartitions("day", key).write.parquet(f"{self.root}/{attempt}/{table}")
        if names is not None:
            names.write.parquet(f"{self.root}/{attempt}/names")
        self._log.add(self.spark.createDataFrame([(name, attempt, self._log.next_number(), merged)], MARKER), 1)

    def _visible(self) -> tuple[str | None, dict[str, str]]:
        """The attempt of the last merge, and name and attempt of each addition since then.

        One marker per addition reaches the driver; ``compact`` keeps them few.
        """
        log = self._log.read()
        last = log.filter("is_merged").agg(F.max(F.struct("version", "attempt"))).first()[0]
        since = log.filter(~F.col("is_merged") & (F.col("version") > (last["version"] if last else -1)))
        newest = since.groupBy("name").agg(F.max(F.struct("version", "attempt"))["attempt"])
        return (last["attempt"] if last else None), {name: attempt for name, attempt in newest.toLocalIterator()}

    def _read(self, table: str) -> DataFrame:
        merged, additions = self._visible()
        attempts = [*([merged] if merged else []), *additions.values()]
        schema = TABLES[table][0]
        if not attempts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{attempt}/{table}" for attempt in attempts])

    def day_holding_last(self, n: int) -> int | None:
        """The day in which the ``n``-th row from the end lies; none if there are no more than ``n`` rows."""
        days = self._read("moments").groupBy("day").agg(F.sum("n").alias("n"))
        total = days.agg(F.sum("n")).first()[0] or 0
        return None if total <= n else value_at(days, "day", total - n)

    def state_since(self, rows: DataFrame, first: datetime | None = None) -> tuple[FeatureState, int]:
        """Feature statistics of what ``rows`` holds from ``first`` on, and how many amounts they rest on.

        ``rows`` are all rows that were added, or those from ``first`` on; only those of its day are read,
        and none if ``first`` is a midnight or not given. The same as ``fit_features`` over those rows.
        """
        moments, countries = self._read("moments"), self._read("countries")
        if first is not None:
            first = first.replace(tzinfo=timezone.utc) if first.tzinfo is None else first.astimezone(timezone.utc)
            day = (first.date() - date(1970, 1, 1)).days
            midnight = datetime.combine(first.date(), time(), timezone.utc)
            is_cut = first > midnight
            moments, countries = (table.filter(F.col("day") >= day + is_cut) for table in (moments, countries))
            if is_cut:
                cut = rows.filter((F.col("event_time") >= F.lit(first)) & (F.col("event_time") < F.lit(midnight + timedelta(days=1))))
                cut = cut.withColumn("day", F.lit(day))
                cut_moments, cut_countries = moments_and_counts(cut, "day")
                moments, countries = moments.unionByName(cut_moments), countries.unionByName(cut_countries)
        return state_from(merged_moments(moments), merged_counts(countries))
