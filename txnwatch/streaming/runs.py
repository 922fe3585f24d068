"""Rows that arrive a few at a time, kept as few files that are quick to look into.

Every addition is a run of its own. As soon as a tier holds ``FAN`` runs they are
merged into one run of the next tier, so there are at most ``FAN`` runs a tier and the
tiers grow with the logarithm of the additions. A run with a key is cut into buckets by
the key's hash, with about ``rows_per_file`` rows each, sorted, and with a Bloom filter;
whoever asks for some keys opens at most one file per key and run, however long the
history.

A run is a folder named ``t<tier>-<first>-<last>-<buckets>-<rows>-<id>``, of additions
``first`` to ``last``. A merged run counts once its write has ended (Spark's own marker),
and then stands for the runs it covers. Those are deleted ``keep_seconds`` later, so that
readers who planned with them can end. One writer per folder.
"""

import re
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Runs of a tier that are merged into one of the next.
FAN = 16
_NAME = re.compile(r"t(\d+)-(\d+)-(\d+)-(\d+)-(\d+)-\w+")


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names_in(spark: SparkSession, path: str) -> list[str]:
    system, place = _files(spark, path)
    return sorted(status.getPath().getName() for status in system.listStatus(place)) if system.exists(place) else []


def delete(spark: SparkSession, path: str) -> None:
    system, place = _files(spark, path)
    system.delete(place, True)


def _ended(spark: SparkSession, path: str) -> float | None:
    """When a run's write ended, in seconds; none if it hasn't."""
    system, place = _files(spark, f"{path}/_SUCCESS")
    return system.getFileStatus(place).getModificationTime() / 1000 if system.exists(place) else None


@dataclass(frozen=True)
class Run:
    path: str
    tier: int
    first: int
    last: int
    buckets: int
    rows: int

    def covers(self, other: "Run") -> bool:
        return self.tier > other.tier and self.first <= other.first and other.last <= self.last


class Runs:
    def __init__(self, spark: SparkSession, path: str, schema: str, key: str | None = None, rows_per_file: int = 1_000_000, keep_seconds: float = 600):
        self.spark, self.path, self.schema, self.key = spark, path, schema, key
        self.rows_per_file, self.keep_seconds = rows_per_file, keep_seconds

    def all(self) -> list[Run]:
        found = [(name, _NAME.fullmatch(name)) for name in names_in(self.spark, self.path)]
        return [Run(f"{self.path}/{name}", *map(int, match.groups())) for name, match in found if match]

    def _split(self) -> tuple[list[Run], list[tuple[Run, float]]]:
        """Runs that count, and those that a merged run stands for, with the time since when."""
        runs = self.all()
        ended = {run: at for run in runs if run.tier and (at := _ended(self.spark, run.path)) is not None}
        since = {run: min((at for other, at in ended.items() if other.covers(run)), default=None) for run in runs}
        return ([run for run in runs if since[run] is None and (not run.tier or run in ended)],
                [(run, at) for run, at in since.items() if at is not None])

    def live(self) -> list[Run]:
        return self._split()[0]

    def next_number(self) -> int:
        return max((run.last for run in self.all()), default=-1) + 1

    def add(self, rows: DataFrame, n_rows: int) -> int:
        """Store rows as a run, merge what has become many; the run's number."""
        number = self.next_number()
        self._write(rows, 0, number, number, n_rows)
        live, covered = self._split()
        tier = 0
        while len(full := [run for run in live if run.tier == tier]) >= FAN:
            n_merged = sum(run.rows for run in full)
            self._write(self._read([run.path for run in full]), tier + 1, min(r.first for r in full), max(r.last for r in full), n_merged)
            live, covered = self._split()
            tier += 1
        for run, since in covered:
            if since + self.keep_seconds < time.time():
                delete(self.spark, run.path)
        return number

    def _write(self, rows: DataFrame, tier: int, first: int, last: int, n_rows: int) -> None:
        buckets = max(1, -(-n_rows // self.rows_per_file)) if self.key else 1
        path = f"{self.path}/t{tier}-{first:012d}-{last:012d}-{buckets}-{n_rows}-{uuid.uuid4().hex[:8]}"
        if not self.key:
            rows.coalesce(1).write.parquet(path)
            return
        dealt = rows.withColumn("bucket", F.pmod(F.xxhash64(self.key), F.lit(buckets))).repartition(buckets, "bucket")
        writer = dealt.sortWithinPartitions("bucket", self.key).write.partitionBy("bucket")
        writer.option(f"parquet.bloom.filter.enabled#{self.key}", "true").option(
            f"parquet.bloom.filter.expected.ndv#{self.key}", str(max(1, min(n_rows, 2 * self.rows_per_file)))).parquet(path)

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(*paths)

    def read(self, hashes: list[int] | None = None) -> DataFrame:
        """All rows, or the files that may hold keys with these hashes (``xxhash64``)."""
        paths = []
        for run in self.live():
            wanted = {value % run.buckets for value in hashes} if hashes is not None else set(range(run.buckets))
            if len(wanted) == run.buckets:
                paths.append(run.path)
            elif wanted:
                system, place = _files(self.spark, f"{run.path}/bucket={{{','.join(map(str, sorted(wanted)))}}}")
                paths += [status.getPath().toString() for status in system.globStatus(place) or []]
        return self._read(paths)
