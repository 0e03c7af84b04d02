from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarterdeck.llm import sharding

NAMES = [f"s{k}" for k in range(7)]


def plain(names, slots):
    """Each shard's whole preference list; shards take turns."""
    import xxhash

    order = []
    for s in names:
        a, b = xxhash.xxh64_intdigest(s, 1) % slots, xxhash.xxh64_intdigest(s, 2) % (slots - 1) + 1
        order.append([(a + b * j) % slots for j in range(slots)])
    owner = {}
    while len(owner) < slots:
        for k, mine in enumerate(order):
            if len(owner) < slots:
                owner[next(x for x in mine if x not in owner)] = k
    return [owner[i] for i in range(slots)]


@pytest.mark.parametrize("slots", [7, 13, 101])
def test_table(slots):
    assert sharding.lookup_table(NAMES, slots).tolist() == plain(NAMES, slots)


def test_balance_and_few_moves():
    table = sharding.lookup_table(NAMES, 10_007)
    sizes = Counter(table.tolist())
    assert max(sizes.values()) - min(sizes.values()) <= 1
    fewer = sharding.lookup_table(NAMES[:-1], 10_007)
    moved = sum(1 for a, b in zip(table, fewer) if a != b and a != 6)
    assert moved < 0.1 * 10_007
    double = Counter(sharding.lookup_table(NAMES, 10_007, [2, 1, 1, 1, 1, 1, 1]).tolist())
    assert double[0] == pytest.approx(2 * double[1], abs=2)
    for bad in (dict(slots=10), dict(shards=["a", "a"]), dict(shards=[])):
        with pytest.raises(ValueError):
            sharding.lookup_table(bad.get("shards", NAMES), bad.get("slots", 101))


def test_placement(spark, tmp_path):
    df = spark.createDataFrame([(k % 900, "x") for k in range(1000)] + [(None, "y")], "doc_id long, shard string")
    df = df.withColumns({"slot": F.lit("x"), "at": F.col("doc_id")})
    out = sharding.place(df, NAMES, slots=101)
    rows = out.collect()
    assert sorted(out.columns) == ["at", "doc_id", "shard", "slot"] and all(r["at"] == r.doc_id for r in rows)
    with pytest.raises(ValueError, match="both"):
        sharding.place(df, NAMES, key_col="shard", slots=101)
    table = sharding.lookup_table(NAMES, 101)
    assert len(rows) == 1001 and all(r.shard == NAMES[table[r.slot]] for r in rows)
    assert len({(r.doc_id, r.shard) for r in rows}) == 901
    assert min(Counter(r.shard for r in rows).values()) > 90
    sharding.write(out, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 1001
    spread = sharding.place(spark.range(300).selectExpr("CAST(NULL AS LONG) AS doc_id", "id AS other"), NAMES, slots=101, fallback=("other",))
    assert spread.select("shard").distinct().count() == 7
    assert sharding.place(df.limit(0).drop("shard"), NAMES, slots=101).count() == 0
