"""The table a stream job keeps its records in, with compaction and retention.

Every micro-batch adds small partitions, valid events by day and hour and records that
could not be read in one place. Compaction brings the small partitions of an hour together
into files of a sensible size, in a new version beside them, and then writes a manifest:
which version holds an hour, and up to which micro-batch. A reader takes the newest
manifest, so it sees either all small partitions of an hour or the files that replace
them. What no kept manifest needs any more is removed later.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.latency import latency_counts
from tidelog.schema import DELTA_EVENT_FIELDS
from tidelog.session import children, exists, matches, remove, stage
from tidelog.sources.event_table import VALID, hours_from
from tidelog.streaming.batch_log import BatchLog

INVALID = "invalid"
#: Day and hour of records that have none.
NO_TIME = "none"
KEYS = ["kind", "event_date", "event_hour"]
RECORD_FIELDS = (
    "event_id STRING, sequence_number STRING, timestamp TIMESTAMP, client_ip STRING, "
    "method STRING, endpoint STRING, status_code BIGINT, response_bytes BIGINT, "
    "source STRING, ingested_at TIMESTAMP, processed_at TIMESTAMP, identity STRING, "
    "position BIGINT, identifier STRING, record_index INT, payload STRING"
)
KEY_FIELDS = "kind STRING, event_date STRING, event_hour STRING"
LIVE_SCHEMA = f"{RECORD_FIELDS}, {KEY_FIELDS}, batch_id BIGINT"
FOLDED_SCHEMA = f"{RECORD_FIELDS}, batch_id BIGINT, version BIGINT, {KEY_FIELDS}"
MANIFEST_SCHEMA = f"{KEY_FIELDS}, held_by BIGINT, through BIGINT, version BIGINT"


def record_rows(decoded: DataFrame, batch_id: int) -> DataFrame:
    """The records of a micro-batch as rows of the table.

    Valid events keep their fields, other records what is needed to send them again.
    """
    valid = F.col("valid")
    only = lambda wanted, name: F.when(wanted, F.col(name)).alias(name)
    part = lambda form: F.when(valid, F.date_format("timestamp", form)).otherwise(F.lit(NO_TIME))
    return decoded.select(
        *[only(valid, name) for name in (*DELTA_EVENT_FIELDS, "ingested_at")],
        F.col("processed_at") if "processed_at" in decoded.columns else F.current_timestamp().alias("processed_at"),
        only(valid, "identity"),
        F.monotonically_increasing_id().alias("position"),
        *[only(~valid, name) for name in ("identifier", "record_index", "payload")],
        F.when(valid, F.lit(VALID)).otherwise(F.lit(INVALID)).alias("kind"),
        part("yyyy-MM-dd").alias("event_date"),
        part("HH").alias("event_hour"),
        F.lit(batch_id).cast("bigint").alias("batch_id"),
    )


def added_up(counts: DataFrame) -> DataFrame:
    return counts.groupBy("valid", "v").agg(F.sum("n").alias("n"))


def read_delta_table(spark: SparkSession, path: str) -> DataFrame:
    """The valid events of a stream job, shaped like decoded delta documents.

    A micro-batch takes the place of a document.
    """
    stored = RecordStore(path).read(spark, VALID)
    return stored.withColumns(
        {
            "doc_key": F.lpad(F.col("batch_id").cast("string"), 20, "0"),
            "valid_document": F.lit(True),
            "valid": F.lit(True),
        }
    ).drop("batch_id", *KEYS)


class RecordStore:
    """The record table at ``path``. One compaction runs at a time; streams and readers
    may go on meanwhile."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")
        self.live, self.folded = f"{self.path}/live", f"{self.path}/folded"
        self.manifests = f"{self.path}/manifest"
        self.latency = BatchLog(f"{self.path}/latency", "valid BOOLEAN, v BIGINT, n BIGINT")

    def write(self, rows: DataFrame, batch_id: int) -> dict:
        """Add a micro-batch, replacing an earlier attempt of it, and count it.

        The rebalance hint lets Spark merge small hours into one file and split large
        ones by size, so an hour that holds most of the events is not one task. The
        counts are taken by the tasks that write, each of which counts once.
        """
        counts = Observation()
        valid = F.col("kind") == VALID
        (
            rows.hint("rebalance", *KEYS)
            .observe(
                counts,
                F.count("*").alias("received_records"),
                F.count_if(valid).alias("processed_records"),
                F.count_if(~valid).alias("invalid_records"),
                F.max(F.unix_micros("timestamp")).alias("newest"),
            )
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*KEYS, "batch_id")
            .parquet(self.live)
        )
        self._count_latencies(rows.sparkSession, batch_id)
        return counts.get

    def _count_latencies(self, spark: SparkSession, batch_id: int) -> None:
        """How often each latency occurs in a micro-batch; such tables can be added up."""
        path = f"{self.live}/kind=*/event_date=*/event_hour=*/batch_id={batch_id}"
        if not matches(spark, path):
            return
        own = spark.read.schema(LIVE_SCHEMA).option("basePath", self.live)
        counted = latency_counts(own.parquet(path).withColumn("valid", F.col("kind") == VALID))
        self.latency.write(counted, batch_id)

    def latencies(self, spark: SparkSession) -> DataFrame:
        """``valid, v, n`` of all micro-batches: latency in microseconds and its count."""
        return added_up(self.latency.read(spark))

    def read(self, spark: SparkSession, kind: str | None = None) -> DataFrame:
        """All records of the newest manifest and the micro-batches after it."""
        manifest = self._manifest(spark)
        live = spark.read.schema(LIVE_SCHEMA).parquet(self.live)
        if kind is not None:
            live = live.filter(F.col("kind") == kind)
        if manifest is None:
            return live
        covered = manifest.select(*KEYS, "through")
        fresh = live.join(covered, KEYS, "left").filter(
            F.col("through").isNull() | (F.col("batch_id") > F.col("through"))
        )
        parts = [fresh.select(*live.columns)]
        if exists(spark, self.folded):
            folded = spark.read.schema(FOLDED_SCHEMA).parquet(self.folded)
            if kind is not None:
                folded = folded.filter(F.col("kind") == kind)
            held = manifest.select(*KEYS, F.col("held_by").alias("version"))
            parts.append(folded.join(held, [*KEYS, "version"], "left_semi").select(*live.columns))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def events_between(self, spark: SparkSession, oldest: datetime, newest: datetime) -> DataFrame:
        """Valid events from the hours between two times.

        Only the folders of these hours are listed, so the cost of a look at a window
        does not grow with the history.
        """
        hours, hour = [], oldest.replace(minute=0, second=0, microsecond=0)
        while hour <= newest:
            hours.append((f"{hour:%Y-%m-%d}", f"{hour:%H}"))
            hour += timedelta(hours=1)
        held = self._held(spark, oldest, newest)
        live, folded = [], []
        for day, hour in hours:
            folder = f"kind={VALID}/event_date={day}/event_hour={hour}"
            version, through = held.get((day, hour), (None, -1))
            batches = [name for name in children(spark, f"{self.live}/{folder}") if name.startswith("batch_id=")]
            live += [f"{self.live}/{folder}/{name}" for name in batches if int(name[9:]) > through]
            if version is not None:
                folded.append(f"{self.folded}/version={version}/{folder}")
        columns = spark.createDataFrame([], LIVE_SCHEMA)
        if live:
            reader = spark.read.schema(LIVE_SCHEMA).option("basePath", self.live)
            columns = columns.unionByName(reader.parquet(*live))
        if folded:
            reader = spark.read.schema(FOLDED_SCHEMA).option("basePath", self.folded)
            columns = columns.unionByName(reader.parquet(*folded).drop("version"))
        return columns

    def _held(self, spark: SparkSession, oldest: datetime, newest: datetime) -> dict:
        """Version and last micro-batch of the compacted hours between two times."""
        manifest = self._manifest(spark)
        if manifest is None:
            return {}
        rows = manifest.filter(
            (F.col("kind") == VALID) & hours_from(oldest) & (F.col("event_date") <= F.lit(f"{newest:%Y-%m-%d}"))
        ).collect()  # a row an hour
        return {(row["event_date"], row["event_hour"]): (row["held_by"], row["through"]) for row in rows}

    def _versions(self, spark: SparkSession) -> list[int]:
        names = children(spark, self.manifests)
        done = [n for n in names if n.startswith("version=") and exists(spark, f"{self.manifests}/{n}/_SUCCESS")]
        return sorted(int(name.removeprefix("version=")) for name in done)

    def _manifest(self, spark: SparkSession, version: int | None = None) -> DataFrame | None:
        """Rows of a manifest, the newest if none is named: a row an hour."""
        versions = self._versions(spark)
        if version is None and not versions:
            return None
        wanted = versions[-1] if version is None else version
        reader = spark.read.schema(MANIFEST_SCHEMA).option("basePath", self.manifests)
        return reader.parquet(f"{self.manifests}/version={wanted}")

    def compact(
        self, spark: SparkSession, through: int, smallest: int = 2, keep_from: datetime | None = None
    ) -> int | None:
        """Bring together what micro-batches up to ``through`` wrote; the new version.

        An hour is rewritten when at least ``smallest`` new partitions have come to it,
        others stay as they are, so the work follows what is new. Hours before
        ``keep_from`` are given up: their events are no longer read. Nothing is written
        when there is nothing to do.
        """
        manifest = self._manifest(spark)
        versions = self._versions(spark)
        version = versions[-1] + 1 if versions else 0
        live = spark.read.schema(LIVE_SCHEMA).parquet(self.live).filter(F.col("batch_id") <= through)
        parts = live.groupBy(*KEYS, "batch_id").agg(F.count("*").alias("rows"))
        if manifest is not None:
            parts = parts.join(manifest.select(*KEYS, F.col("through").alias("done")), KEYS, "left").filter(
                F.col("done").isNull() | (F.col("batch_id") > F.col("done"))
            )
        expired = F.lit(False) if keep_from is None else (F.col("kind") == VALID) & ~hours_from(keep_from)
        new = parts.groupBy(*KEYS).agg(F.count("*").alias("new"))
        if manifest is not None and keep_from is not None:
            old = manifest.filter(F.col("held_by").isNotNull() & expired).select(*KEYS, F.lit(0).alias("new"))
            new = new.unionByName(old).groupBy(*KEYS).agg(F.sum("new").alias("new"))
        chosen = stage(
            new.withColumn("expired", expired).filter(F.col("expired") | (F.col("new") >= smallest)), "compaction"
        )
        if not chosen.limit(1).count():
            return None
        kept = chosen.filter(~F.col("expired")).select(*KEYS)
        rows = self.read(spark).filter(F.col("batch_id") <= through).join(kept, KEYS, "left_semi")
        (
            rows.hint("rebalance", *KEYS)
            .write.mode("overwrite")
            .partitionBy(*KEYS)
            .parquet(f"{self.folded}/version={version}")
        )
        entries = chosen.select(
            *KEYS,
            F.when(~F.col("expired"), F.lit(version)).cast("bigint").alias("held_by"),
            F.lit(through).cast("bigint").alias("through"),
        )
        if manifest is not None:
            others = manifest.drop("version").join(chosen.select(*KEYS), KEYS, "left_anti")
            entries = entries.unionByName(others)
        entries.coalesce(1).write.mode("overwrite").parquet(f"{self.manifests}/version={version}")
        return version

    def _done(self, spark: SparkSession) -> int | None:
        """The last micro-batch that any hour of the newest manifest holds."""
        manifest = self._manifest(spark)
        return None if manifest is None else manifest.agg(F.max("through")).first()[0]

    def vacuum(self, spark: SparkSession, keep: int = 2) -> None:
        """Remove what the last ``keep`` manifests do not need. A reader that planned
        with an older manifest must be done by then."""
        done = self._done(spark)
        if done is not None:
            self.latency.fold(spark, done, added_up)
        versions = self._versions(spark)
        if len(versions) < keep:
            return
        kept = versions[-keep:]
        needed = set()
        for version in kept:
            rows = self._manifest(spark, version).select("held_by").distinct().collect()  # a row a version
            needed |= {row["held_by"] for row in rows}
        for row in self._manifest(spark, kept[0]).toLocalIterator():  # a row an hour
            hour = f"{self.live}/kind={row['kind']}/event_date={row['event_date']}/event_hour={row['event_hour']}"
            names = children(spark, hour)
            gone = [n for n in names if n.startswith("batch_id=") and int(n[9:]) <= row["through"]]
            for name in gone:
                remove(spark, f"{hour}/{name}")
        for name in children(spark, self.folded):
            if name.startswith("version=") and int(name[8:]) < kept[0] and int(name[8:]) not in needed:
                remove(spark, f"{self.folded}/{name}")
        for version in versions[:-keep]:
            remove(spark, f"{self.manifests}/version={version}")
