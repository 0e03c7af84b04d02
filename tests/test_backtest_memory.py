"""What the panel holds of a group while it is summed, its values, and how often the backtest makes it."""

import random
from datetime import datetime

from pyspark.sql import functions as F

from quarterdeck.plans import bindings as b
from quarterdeck.plans import queries

DATA = "/root/testdata/sf0.001"


def old_panel(lineitem):
    """The sums as wide decimals."""
    price, less, tax, pieces = (F.col(c).cast(k) for c, k in (("l_extendedprice", "decimal(12,2)"), ("l_discount", "decimal(4,2)"), ("l_tax", "decimal(4,2)"), ("l_quantity", "decimal(12,2)")))
    where = lambda c, v: F.when(F.col(c) == v, price).otherwise(F.lit(0).cast("decimal(12,2)"))
    totals = [price, price * (1 - less), price * tax, where("l_returnflag", "N"), where("l_returnflag", "R"), where("l_returnflag", "A"), where("l_linestatus", "O")]
    means = [(less, 100), (tax, 100), (pieces, 1), (less + tax, 100)]
    sums = [F.sum(x).cast("double").alias(f"t{k}") for k, x in enumerate(totals)] + [(F.sum(x).cast("double") / F.count("*") * by).alias(f"m{k}") for k, (x, by) in enumerate(means)]
    return lineitem.groupBy("l_suppkey", b.quarter_end(F.to_date("l_shipdate"))).agg(*sums)


def test_a_group_is_a_few_numbers(spark):
    node = b.panel(spark, DATA)._jdf.queryExecution().sparkPlan()
    partial = [node]
    while node.children().size():
        node = node.children().apply(0)
        partial.append(node)
    kinds = [n.schema().simpleString() for n in partial if n.nodeName() == "HashAggregate"][-1]
    assert "decimal" not in kinds and kinds.count("bigint") <= 14


def test_sums_are_those_of_decimals(spark, tmp_path):
    """Nulls, returns, prices whose third digit is rounded, and large ones."""
    rng, rows = random.Random(5), []
    for k in range(3000):
        number = lambda most: None if rng.random() < 0.05 else rng.choice([1, 1, 1, -1]) * rng.random() * most
        rows.append((k % 7, rng.choice([5e9, 1e5, 1.0, 0.005]) * rng.random() if rng.random() < 0.95 else None, number(50), number(1), number(0.1), rng.choice(["N", "R", "A", None]), rng.choice(["O", "F", None]), datetime(1995, rng.randrange(1, 13), 3)))
    spark.createDataFrame(rows, "l_suppkey long, l_extendedprice double, l_quantity double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp").write.parquet(str(tmp_path / "lineitem.parquet"))
    for folder in (str(tmp_path), DATA):
        found, known = b.panel(spark, folder), old_panel(b.table(spark, folder, "lineitem"))
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, known.collect()), key=repr)


def test_backtest_makes_the_panel_once(spark, monkeypatch):
    whole, made = b.panel(spark, DATA), spark.sparkContext.accumulator(0)
    rows = whole.count()

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(b, "panel", lambda *_: whole.mapInArrow(counted, whole.schema))
    queries.QUERIES["b06_run_backtest"](spark, DATA).count()
    assert made.value == rows
