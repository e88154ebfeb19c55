"""The derived inputs as DataFrames, and small helpers for the queries."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.documents import BYTE_ORDER_MARK
from tidelog.operators.aggregates import add_up, batch_metrics, endpoint_summary, minute_facts, unit_facts
from tidelog.operators.events import decode_records
from tidelog.operators.dedup import dedup_events, delta_events
from tidelog.operators.parse import parse_lines, valid_events
from tidelog.operators.window import recent_window, split_by_window
from tidelog.plans.incremental_window import IncrementalWindow
from tidelog.session import configure, scratch_path, stage
from tidelog.sources.envelopes import explode_records
from tidelog.sources.event_table import EventTable
from tidelog.workload import derive

# What the queries ask for: a window of a minute, and spikes from 1.5 times on.
WINDOW = 60
RATIO = 1.5
MINIMUM = 10


def spread_out(table: DataFrame) -> DataFrame:
    """Use all cores for a table that comes in fewer splits than there are cores.

    Building and parsing log text costs far more than moving these small rows. A large
    table has enough splits and stays where it is.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table


class Frames:
    """Everything is lazy and reads the whole ``events`` table."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        events = spread_out(spark.read.parquet(f"{sf_dir}/events.parquet"))
        view = f"events_{uuid4().hex}"
        events.createOrReplaceTempView(view)
        self.dialect = derive.spark_dialect(view)

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(text)

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)

    def requests(self) -> DataFrame:
        return self.sql(derive.requests(self.dialect))

    def lines(self) -> DataFrame:
        return self.sql(derive.lines(self.dialect)).select("value")

    def line_files(self) -> str:
        """The log as text files in a fresh folder, one of each split of the events."""
        path = self.scratch("lines")
        self.lines().write.text(path)
        return path

    def event_table(self) -> EventTable:
        """The log as a stored event table in a fresh folder."""
        table = EventTable(self.spark, self.scratch("event-table"))
        table.write(self.lines())
        return table

    def parsed(self) -> DataFrame:
        return parse_lines(self.lines())

    def events(self) -> DataFrame:
        return valid_events(self.parsed())

    def facts(self) -> DataFrame:
        return unit_facts(self.events())

    def tables(self) -> dict[str, DataFrame]:
        """The batch tables, all from the same minute facts."""
        facts = minute_facts(self.events())
        return batch_metrics(facts, endpoint_summary(facts))

    def window(self, seconds: int = WINDOW) -> DataFrame:
        return recent_window(self.events(), seconds)

    def window_facts(self) -> DataFrame:
        return unit_facts(self.window())

    def sides(self) -> tuple[DataFrame, DataFrame]:
        """Facts from before the window and from inside it; the log is read once for both."""
        marked = split_by_window(self.events(), WINDOW)
        facts = stage(add_up(unit_facts(marked, "recent"), "recent"), "sides")
        return facts.filter(~F.col("recent")), facts.filter("recent")

    def payloads(self) -> DataFrame:
        return self.sql(derive.payloads(self.dialect))

    def invocations(self) -> DataFrame:
        return self.sql(derive.invocations(self.dialect))

    def records(self) -> DataFrame:
        return explode_records(self.invocations())

    def decoded(self) -> DataFrame:
        return decode_records(self.records())

    def delta_documents(self) -> DataFrame:
        text = derive.delta_documents(self.dialect, f"'{BYTE_ORDER_MARK}'")
        return self.sql(text).select("doc_key", "value")

    def classified(self) -> DataFrame:
        return dedup_events(stage(delta_events(self.delta_documents()), "decoded"))

    def incremental(self) -> IncrementalWindow:
        """The delta documents handled in three runs, the last third of them first."""
        job = IncrementalWindow(self.scratch("incremental"), WINDOW)
        third = F.pmod(F.substring("doc_key", 5, 10).cast("bigint"), F.lit(3))
        documents = self.delta_documents()
        for run in range(3):
            job.process(documents.filter(third == 2 - run), run)
        return job

    def metric_documents(self) -> DataFrame:
        return self.sql(derive.metric_documents(self.dialect)).select("doc_key", "value")

    def baseline_documents(self) -> DataFrame:
        return self.sql(derive.baseline_documents(self.dialect)).select("doc_key", "value")

    def document_files(self, documents: DataFrame) -> str:
        """One file per document in a fresh folder; the key is part of the path."""
        path = self.scratch("documents")
        documents.write.partitionBy("doc_key").text(path)
        return path


def path_key(path: Column) -> Column:
    return F.regexp_extract(path, "doc_key=([^/]+)/", 1)


def printed(df: DataFrame) -> DataFrame:
    """Timestamps as text, so that no engine's zone setting matters."""
    return df.withColumns(
        {
            name: F.date_format(name, "yyyy-MM-dd HH:mm:ss")
            for name, kind in df.dtypes
            if kind == "timestamp"
        }
    )
