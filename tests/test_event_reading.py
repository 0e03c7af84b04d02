"""Parameters are looked up by position, and raw events are read once for sessions."""

from pyspark.sql import functions as F

from quarterdeck.functions import columns as c
from quarterdeck.operators import product
from quarterdeck.plans import bindings as b

DATA = "/root/testdata/sf0.001"
PARAMS = "p array<struct<key string, value struct<string_value string, int_value long, float_value double, double_value double>>>"


def entry(key, text=None, number=None):
    return (key, (text, number, None, None))


def test_first_entry_with_a_key_counts(spark):
    rows = [([entry("a", "7"), entry("a", "8", 9)],), ([None, entry(None, "x"), entry("a", "y", 3)],), ([entry("b", "1")],), ([],), (None,)]
    df = spark.createDataFrame(rows, PARAMS).coalesce(1)
    found = df.select(c.param_str(F.col("p"), "a").alias("s"), c.param_int(F.col("p"), "a").alias("n")).collect()
    assert [(r.s, r.n) for r in found] == [("7", 7), ("y", 3), (None, None), (None, None), (None, None)]


def test_no_lambda_is_interpreted_for_an_event(spark):
    events = product.normalize_events(b.raw_events(spark, DATA))
    assert "lambda" not in events._jdf.queryExecution().optimizedPlan().toString()


def test_sessions_read_raw_events_once(spark):
    raw, read = b.raw_events(spark, DATA), spark.sparkContext.accumulator(0)
    rows = raw.count()

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    s = product.sessions(product.normalize_events(raw.mapInArrow(counted, raw.schema)))
    assert s.count() and read.value == rows
