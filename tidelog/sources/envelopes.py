"""Transport envelopes: invocations that carry a list of encoded records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.columns import with_once
from tidelog.functions.documents import as_list, field, is_object, parse_document

RECORD = "record"


def explode_records(invocations: DataFrame, column: str = "value") -> DataFrame:
    """One row per record: the invocation's other columns, ``record_index``, ``record``.

    ``Records`` that is missing or not a list is an empty batch. Elements that are not
    objects stay in and become null, so that they can be counted as invalid. A line may
    also be one bare record, which is a batch of its own. A line that cannot be read is
    one invalid record.
    """
    parsed = with_once(invocations, __document=parse_document(F.col(column)))
    keep = [name for name in invocations.columns if name != column]
    invocation = F.col("__document")
    bare = F.when(
        is_object(invocation) & field(invocation, "kinesis", "variant").isNotNull(),
        F.array(invocation),
    )
    unreadable = F.when(invocation.isNull(), F.array(F.lit(None).cast("variant")))
    records = F.coalesce(as_list(invocation, "$.Records"), bare, unreadable)
    exploded = parsed.select(*keep, F.posexplode(records).alias("record_index", "__element"))
    record = F.when(is_object(F.col("__element")), F.col("__element"))
    return exploded.select(*keep, "record_index", record.alias(RECORD))
