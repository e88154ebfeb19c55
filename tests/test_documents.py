"""Documents above the size limit of a VARIANT."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tests.samples import event
from tidelog.functions.documents import parse_document
from tidelog.operators.dedup import delta_events
from tidelog.sources.documents import document_totals, metric_rows, parse_delta_documents, parse_metric_documents

HEAD = '{"document_type": "speed_batch_delta", "events": ['


def test_too_large_documents_stop_the_job_with_their_name(spark):
    small = spark.createDataFrame([("a", "{"), ("b", '{"x": 1}'), ("c", None)], "doc_key STRING, value STRING")
    read = small.select(parse_document(F.col("value"), F.col("doc_key")).isNull().alias("none"))
    assert [row.none for row in read.collect()] == [True, False, True]

    filled = F.concat(F.lit(HEAD), F.repeat(F.lit('"' + "x" * 1020 + '", '), 130 << 10), F.lit("1"))
    one = spark.range(1).select(F.lit("big.json").alias("doc_key"), F.concat(filled, F.lit("]}")).alias("value"))
    with pytest.raises(Exception, match="size limit of a VARIANT: big.json"):
        one.select(parse_document(F.col("value"), F.col("doc_key"))).collect()

    broken = one.select("doc_key", F.concat(filled, F.lit("]")).alias("value"))
    [row] = parse_delta_documents(broken).select("valid_document").collect()
    assert row.valid_document is False
    [row] = parse_delta_documents(one).select("valid_document", F.size("events").alias("n")).collect()
    assert (row.valid_document, row.n) == (True, (130 << 10) + 1)


def test_a_large_delta_document_gives_all_its_events(spark):
    """140 MiB: the events of the text, invalid ones and other elements as they are."""
    item = json.dumps(event("e-#", "2026-07-31T10:00:00+00:00", endpoint="/" + "x" * 900, response_bytes=2**53 + 1, sequence_number=None))
    left, right = item.split("#")
    listed = F.array_join(
        F.transform(F.sequence(F.lit(1), F.lit(130_000)), lambda n: F.concat(F.lit(left), n.cast("string"), F.lit(right))), ", "
    )
    head = F.lit('{"schema_version": 1, "more": {"a": [1, 2]}, "document_type": "speed_batch_delta", "events": ["text", 7, ')
    one = spark.range(1).select(F.lit("big.json").alias("doc_key"), F.concat(head, listed, F.lit(", null]}")).alias("value"))
    assert one.select(F.octet_length("value")).first()[0] > 140 << 20
    found = delta_events(one).agg(
        F.count("*"), F.count_if("valid"), F.countDistinct("identity"), F.max("position"), F.max("response_bytes")
    ).first()
    assert tuple(found) == (130_003, 130_000, 130_000, 130_002, 2**53 + 1)
    other = one.withColumn("value", F.replace("value", F.lit("speed_batch_delta"), F.lit("other")))
    assert [row.valid_document for row in parse_delta_documents(other).select("valid_document").collect()] == [False]


def test_a_large_metric_document_gives_all_its_rows(spark):
    """Maps are read entry by entry, and counts keep all their digits."""
    def members(value):
        entries = F.transform(
            F.sequence(F.lit(1), F.lit(160_000)),
            lambda n: F.concat(F.lit('"/' + "y" * 420), n.cast("string"), F.lit('":'), F.lit(value)),
        )
        return F.array_join(entries, ",")

    text = F.concat(
        F.lit('{"generated_at":"now","batch_metrics":{"total_valid_records":9007199254740993,"requests_per_endpoint":{'),
        members("9007199254740993"), F.lit('},"error_rates":{'), members('{"error_rate":0.25,"total_requests":4}'),
        F.lit('},"response_byte_totals":{"/a":"many","/b":"12"}}}'),
    )
    one = spark.range(1).select(F.lit("m").alias("doc_key"), text.alias("value"))
    small = spark.createDataFrame(
        [("s", '{"batch_metrics":{"total_valid_records":5,"requests_per_endpoint":{"/a":3}}}'), ("x", "not json")],
        "doc_key STRING, value STRING",
    )
    parsed = parse_metric_documents(one.unionByName(small), "batch")
    found = {
        (r.doc_key, r.metric): (r.n, r.top, r.rate)
        for r in metric_rows(parsed).groupBy("doc_key", "metric").agg(
            F.count("*").alias("n"), F.max("count").alias("top"), F.max("rate").alias("rate")
        ).collect()
    }
    assert found == {
        ("m", "requests_per_endpoint"): (160_000, 9007199254740993, None),
        ("m", "error_rates"): (160_000, None, 0.25),
        ("m", "response_byte_totals"): (1, 12, None),
        ("s", "requests_per_endpoint"): (1, 3, None),
    }
    totals = {r.doc_key: (r.total_valid_records, r.generated_at) for r in document_totals(parsed).collect()}
    assert totals == {"m": (9007199254740993, "now"), "s": (5, None), "x": (None, None)}
