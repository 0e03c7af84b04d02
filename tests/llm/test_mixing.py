import pytest
from pyspark.sql import functions as F

from quarterdeck.llm import mixing


def goal(sizes):
    """Targets by plain water-filling: sources by code point, nulls last."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in stopped)
        free = sum(weight[s] for s in names if s not in stopped)
        share = {s: left * weight[s] / free for s in names if s not in stopped}
        above = {s for s, t in share.items() if t > 3 * sizes[s]}
        if not above:
            return {s: share.get(s, 3.0 * sizes[s]) for s in names}
        stopped |= above


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, ["big", "mid", "tiny", "é", None, "empty"][0 if k % 3 == 0 else k % 6], ("w " * (k * 7919 % 90 + 5)).strip() if k % 6 != 5 or k % 3 == 0 else None) for k in range(6000)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("size", F.lit("clash"))


def test_targets_and_taken(docs):
    rows = mixing.copies(docs).collect()
    assert len(rows) == 6000
    sizes, taken = {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.copies * r["size"]
        assert 0 <= r.copies <= 3
    expected = goal(sizes)
    for r in rows:
        assert r.target == pytest.approx(expected[r.source], rel=1e-12) and r.source_size == sizes[r.source]
    for s, t in expected.items():
        assert abs(taken[s] - t) <= max(0.02 * t, 150)


def test_systematic_counts(docs):
    """Within a source the running number of copies never strays by a whole one from what is expected."""
    rows = [r for r in mixing.copies(docs).collect() if r.source == "big"]
    rate = rows[0].target / rows[0].source_size
    rows.sort(key=lambda r: (int(r["size"] ** 0.5),))
    assert abs(sum(r.copies for r in rows) - rate * len(rows)) <= 1


def test_reruns_and_partitions_agree(docs):
    view = lambda df, **o: sorted((r.id, r.copies) for r in mixing.copies(df, **o).collect())
    assert view(docs) == view(docs.repartition(7)) and view(docs) != view(docs, seed=1)


def test_mix_repeats_rows(docs):
    drawn = {r.id: r.copies for r in mixing.copies(docs).collect()}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {i: n for i, n in drawn.items() if n}


def test_defined_cases(spark):
    df = spark.createDataFrame([(None, None, None), (1, "a", ""), (1, "a", ""), (2, "a", "x\ty\x0bz")], "doc_id long, source string, text string")
    rows = mixing.copies(df).collect()
    assert sorted(r["size"] for r in rows) == [0, 0, 0, 3]
    assert {(r.source, r.target) for r in rows} == {("a", 3.0), (None, 0.0)}
    assert mixing.copies(df.limit(0)).count() == 0 and mixing.mix(df.limit(0)).count() == 0
    nothing = spark.createDataFrame([(1, "a", None)], "doc_id long, source string, text string")
    assert [(r.target, r.copies) for r in mixing.copies(nothing).collect()] == [(0.0, 0)]
