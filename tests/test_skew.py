"""A hot key: one (patient, day, exercise) with most of the sessions."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from equilibra import codes as C
from equilibra.plans import PRODUCTS
from equilibra.sources.fixtures import _bundle, _component


def _hot_bundles(spark, n=6000, hot=5000, offset="+00:00", own_scores=False):
    i = F.col("id")
    patient = F.when(i < hot, F.lit("hot")).otherwise(F.concat(F.lit("p"), i.cast("string")))
    when = F.concat(F.lit("2021-06-01T"), F.format_string("%02d:%02d:%02d", (i / 3600 % 24).cast("int"), (i / 60 % 60).cast("int"), (i % 60).cast("int")), F.lit(offset))
    comps = F.array(
        _component(C.SESSION_SCORE, quantity=i if own_scores else i % 10),
        _component(C.DURATION, quantity=i % 7),
        _component(C.REPETITIONS, quantity=i % 3),
        _component(C.DISORIENTATION, flag=i % 2 == 0),
        _component(C.SPEED_OF_MOVEMENT, text=F.lit("x"), data=F.lit("[[[1 2]]]"), times=F.lit("[[[0 1000]]]")),
    )
    return spark.range(n).select(_bundle(F.concat(F.lit("Patient/"), patient), when, F.lit("ex"), comps).alias("entry"))


CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    # keep every stage at 8 tasks: a partition written by one map task
    # cannot be split (at scale many tasks write the hot key's rows)
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


# Per key: one speed text x two flag values x the scores with their durations x three repetitions.
@pytest.mark.parametrize(
    "given, rows",
    [
        ({}, 2 * 5000 * 3),  # each score has the duration of its start time
        ({"offset": "Z", "own_scores": True}, 2 * 5000 * 7 * 3),  # no start time: all durations of the day
    ],
    ids=["sessions", "no_start_time"],
)
def test_hot_key_report_is_split(spark, given, rows):
    old = {k: spark.conf.get(k, None) for k in CONF}
    try:
        for k, v in CONF.items():
            spark.conf.set(k, v)
        df = PRODUCTS["session_report"](_hot_bundles(spark, **given))
        df = df.withColumn("_task", F.spark_partition_id())
        tasks = Counter(r["_task"] for r in df.collect() if r[C.PATIENT] == "hot")
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert tasks.total() == rows
    assert len(tasks) > 1  # of the last join, whose rows the report's are
    assert "skew=true" in plan and "FullOuter" not in plan
