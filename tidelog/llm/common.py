"""What the operators of this package share: input, words, tables between jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import stage

#: White space and words of the contracts: only these six characters separate words.
BLANKS = r"[\x20\x09-\x0D]+"
BLANK_CHARACTERS = " \t\n\x0b\x0c\r"

#: Lower-cases A to Z and nothing else, as the contracts of words ask.
LOWER_AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
CODEC = "spark.sql.parquet.compression.codec"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: str) -> list[str]:
    """The words of a text, A to Z lower-cased; other white space is part of words."""
    plain = text.translate(LOWER_AZ)
    if plain.isascii() and not any(mark in plain for mark in "\x1c\x1d\x1e\x1f"):
        return plain.split()
    for blank in "\t\n\x0b\x0c\r":
        plain = plain.replace(blank, " ")
    return [word for word in plain.split(" ") if word]


def id_remainder(doc_id: Column, parts: int) -> Column:
    """Remainder of the checksum of the id written as text; -1 without an id."""
    checksum = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(checksum % F.lit(parts), F.lit(-1))


class Scratch:
    """Tables written between two jobs of one operator, in the shared folder.

    The shuffle files of a job go as soon as its table is written, and a table that no
    later step reads can be dropped, so that disk holds one step at a time.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        self.files: dict[int, list[str]] = {}

    def write(
        self, table: DataFrame, name: str, rows_at_once: int | None = None, codec: str | None = None
    ) -> DataFrame:
        """rows_at_once: rows of a batch that goes to a Python process, for large rows.
        codec: of the files, the session's by default."""
        settings = {CLEAN_UP: "true"}
        if codec is not None:
            settings[CODEC] = codec
        if rows_at_once is not None:
            settings[BATCH_ROWS] = str(rows_at_once)
        before = {key: self.spark.conf.get(key, None) for key in settings}
        for key, value in settings.items():
            self.spark.conf.set(key, value)
        try:
            written = stage(table, f"{self.name}-{name}")
        finally:
            for key, value in before.items():
                self.spark.conf.unset(key) if value is None else self.spark.conf.set(key, value)
        return written

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables that write() returned; nothing may read them any more."""
        jvm, context = self.spark._jvm, self.spark.sparkContext
        for table in tables:
            for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
