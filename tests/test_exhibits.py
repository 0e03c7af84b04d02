"""Exhibits of any size, and how often change sets read their source."""

from quarterdeck.plans import bindings as b
from quarterdeck.plans import queries
from quarterdeck.sources import writers

DATA = "/root/testdata/sf0.001"


def test_small_exhibit_is_one_file_and_a_large_one_several(spark, tmp_path):
    df = spark.range(0, 20_000, 1, 4).selectExpr("id AS k", "md5(cast(id AS string)) AS name")
    writers.write_exhibit(df.filter("k < 3"), str(tmp_path / "small"))
    assert len(list((tmp_path / "small").glob("*.csv"))) == 1
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100000")
    try:
        writers.write_exhibit(df, str(tmp_path / "large"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = list((tmp_path / "large").glob("*.csv"))
    assert len(files) > 1 and all(f.read_text().startswith("k,name\n") for f in files)
    found = spark.read.csv(str(tmp_path / "large"), header=True)
    assert found.count() == 20_000 and found.distinct().count() == 20_000


def test_empty_exhibit_has_its_header(spark, tmp_path):
    writers.write_exhibit(spark.createDataFrame([], "k long, name string"), str(tmp_path / "none"))
    assert [f.read_text() for f in (tmp_path / "none").glob("*.csv")] == ["k,name\n"]


def test_change_sets_make_the_panel_once(spark, monkeypatch):
    whole, made = b.panel(spark, DATA), spark.sparkContext.accumulator(0)
    rows = whole.count()

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(b, "panel", lambda *_: whole.mapInArrow(counted, whole.schema))
    queries.QUERIES["s16_change_sets"](spark, DATA).count()
    assert made.value == rows
