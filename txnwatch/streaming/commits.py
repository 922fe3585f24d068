"""The commit log of the stored tables, and the index of the keys they hold.

A batch writes its rows to a folder of its own attempt in each table, then its keys to
the indexes, and last of all one marker to the log. Readers take the rows of attempts
that the newest marker of a batch names, so both tables change at one moment: what a
batch that stopped half-way has written is never seen, and a batch that is replayed
stays visible as it was until its new marker is there.
"""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from txnwatch.operators.lookups import BROADCAST_ROWS
from txnwatch.streaming.runs import Runs, delete, names_in

COMMIT = "stream string, batch_id long, attempt string, version long, processed_at timestamp, n_rows long, n_flagged long, is_replay boolean"
ATTEMPT = ["stream", "batch_id", "attempt"]
#: Markers of single batches stay for a week, for those who follow them.
FOLLOWED_SECONDS = 7 * 86_400
#: Most keys that are listed in the scan of an index.
LISTED = 500


def log_of(spark: SparkSession, root: str, stream: str) -> Runs:
    return Runs(spark, f"{root}/commits/{stream}", COMMIT, keep_seconds=FOLLOWED_SECONDS)


def all_commits(spark: SparkSession, root: str) -> DataFrame:
    """Every marker of every stream, replays too."""
    streams = names_in(spark, f"{root}/commits")
    paths = [run.path for stream in streams for run in log_of(spark, root, stream).live()]
    return Runs(spark, root, COMMIT)._read(paths)


def visible_attempts(spark: SparkSession, root: str) -> DataFrame:
    """stream, batch_id, attempt: the newest marker of each batch."""
    newest = F.max(F.struct("version", "attempt"))["attempt"].alias("attempt")
    return all_commits(spark, root).groupBy("stream", "batch_id").agg(newest)


def commit(spark: SparkSession, root: str, stream: str, batch_id: int, attempt: str, processed_at: datetime, metrics: dict, is_replay: bool) -> None:
    log = log_of(spark, root, stream)
    row = (stream, batch_id, attempt, log.next_number(), processed_at, metrics["n_rows"], metrics["n_flagged"], is_replay)
    log.add(spark.createDataFrame([row], COMMIT), 1)


def committed_time(spark: SparkSession, root: str, stream: str, batch_id: int) -> int | None:
    """Microseconds of the time that a batch had when it was first committed."""
    own = log_of(spark, root, stream).read().filter(F.col("batch_id") == batch_id)
    return own.agg(F.min(F.unix_micros("processed_at"))).first()[0]


def last_committed(spark: SparkSession, root: str, stream: str) -> int:
    found = log_of(spark, root, stream).read().agg(F.max("batch_id")).first()[0]
    return -1 if found is None else found


class KeyIndex:
    """Which batch attempt holds a key, for one stored table; every stream has runs of its own."""

    def __init__(self, spark: SparkSession, root: str, table: str, key: str, rows_per_file: int = 1_000_000, keep_seconds: float = 600):
        self.spark, self.root, self.folder, self.key = spark, root, f"{root}/keys/{table}", key
        self.rows_per_file, self.keep_seconds = rows_per_file, keep_seconds

    def _runs(self, stream: str) -> Runs:
        schema = f"{self.key} string, stream string, batch_id long, attempt string"
        return Runs(self.spark, f"{self.folder}/{stream}", schema, self.key, self.rows_per_file, self.keep_seconds)

    def add(self, stream: str, rows: DataFrame, n_rows: int) -> None:
        """Keys of rows with their stream, batch_id and attempt."""
        self._runs(stream).add(rows.select(self.key, *ATTEMPT), n_rows)

    def entries(self, rows: DataFrame, n_rows: int, listed: list | None = None) -> DataFrame:
        """Entries, committed or not, of the keys that ``rows`` has.

        The keys of a small batch, with their hashes, are listed in the scan, which opens the buckets that may hold
        them and skips what their Bloom filters rule out. A larger batch is joined with the whole index.
        """
        found = None
        if n_rows <= LISTED:
            listed = keys_of(rows, self.key) if listed is None else listed
            self.spark.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", LISTED)
        for stream in names_in(self.spark, self.folder):
            runs = self._runs(stream)
            if n_rows <= LISTED:
                part = runs.read([key_hash for _, key_hash in listed]).filter(among(self.key, [key for key, _ in listed]))
            else:
                keys = rows.select(self.key)
                part = runs.read().join(F.broadcast(keys) if n_rows <= BROADCAST_ROWS else keys, self.key, "left_semi")
            found = part if found is None else found.unionAll(part)
        return self._runs("none").read() if found is None else found

    def known(self, rows: DataFrame, n_rows: int, stream: str, batch_id: int, listed: list | None = None) -> DataFrame:
        """Keys of ``rows`` that any other batch has committed; what a batch holds itself is replaced when it is replayed."""
        others = self.entries(rows, n_rows, listed).filter((F.col("stream") != stream) | (F.col("batch_id") != batch_id))
        return others.join(visible_attempts(self.spark, self.root), ATTEMPT, "left_semi").select(self.key).distinct()

    def new(self, rows: DataFrame, n_rows: int, stream: str, batch_id: int, listed: list | None = None) -> DataFrame:
        """``rows`` whose keys no other batch has committed. The entries of a small batch are few and looked at here: mostly there are none."""
        if n_rows > LISTED:
            known = self.known(rows, n_rows, stream, batch_id)
            return rows.join(F.broadcast(known) if n_rows <= BROADCAST_ROWS else known, self.key, "left_anti")
        found = [entry for entry in self.entries(rows, n_rows, listed).collect() if (entry["stream"], entry["batch_id"]) != (stream, batch_id)]
        if not found:
            return rows
        seen = visible_attempts(self.spark, self.root).filter(among("attempt", sorted({entry["attempt"] for entry in found})))
        seen = {tuple(row) for row in seen.select(*ATTEMPT).collect()}
        known = sorted({entry[self.key] for entry in found if tuple(entry[name] for name in ATTEMPT) in seen})
        return rows.filter(~among(self.key, known)) if known else rows

    def rebuild(self, stored: DataFrame) -> None:
        """The index anew from all visible rows (with their attempt), as one run per stream; runs there were are deleted after it."""
        for stream in [row[0] for row in stored.select("stream").distinct().collect()]:
            runs = self._runs(stream)
            before, own = runs.all(), stored.filter(F.col("stream") == stream)
            runs.add(own.select(self.key, *ATTEMPT), own.count())
            for run in before:
                delete(self.spark, run.path)


def among(name: str, values: list[str]) -> Column:
    """Whether a column is one of so many texts, in one expression."""
    quoted = ",".join("'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'" for value in values)
    return F.expr(f"`{name}` IN ({quoted})") if values else F.lit(False)


def keys_of(rows: DataFrame, key: str) -> list[tuple[str, int]]:
    """Keys and their hashes, of a batch of at most ``LISTED`` rows."""
    return [tuple(row) for row in rows.select(key, F.xxhash64(key)).collect()]


def drop_unseen_attempts(spark: SparkSession, root: str, tables: tuple[str, ...] = ("transactions", "alerts")) -> int:
    """Delete what no newest marker names: attempts that were replaced or never ended. For quiet times; how many went."""
    seen = {tuple(row) for row in visible_attempts(spark, root).toLocalIterator()}
    n_deleted = 0
    for table in tables:
        for stream in names_in(spark, f"{root}/{table}"):
            for batch in names_in(spark, f"{root}/{table}/{stream}"):
                for attempt in names_in(spark, f"{root}/{table}/{stream}/{batch}"):
                    if not all("=" in part for part in (stream, batch, attempt)) or stream == "stream=none":
                        continue
                    owner = stream.partition("=")[2], int(batch.partition("=")[2]), attempt.partition("=")[2]
                    if owner not in seen:
                        delete(spark, f"{root}/{table}/{stream}/{batch}/{attempt}")
                        n_deleted += 1
    return n_deleted
