import json
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from quarterdeck import schemas
from quarterdeck.operators import staging
from quarterdeck.sources import readers, writers


def page(endpoint, total, rows):
    return {"request": {"endpoint": endpoint, "params": {}}, "response": {"meta": {"total": total}, "data": [{"data": r} for r in rows]}}


FIELDS = schemas.struct(CERT=schemas.TEXT, ASSET=schemas.TEXT)


def landed(folder, endpoint, sizes, total):
    for k, n in enumerate(sizes):
        rows = [{"CERT": f"{endpoint}-{k}-{i}", "ASSET": str(i)} for i in range(n)]
        (folder / f"{endpoint}-{k}.json").write_text(json.dumps(page(endpoint, total, rows)))


def test_any_split_into_pages_adds_up(spark, tmp_path):
    """Two endpoints, each cut into pages at random, an empty last page among them."""
    rng, wanted = random.Random(17), 0
    for endpoint in ("loans", "offices"):
        sizes = [rng.randrange(1, 9) for _ in range(rng.randrange(1, 6))] + [0] * (endpoint == "offices")
        landed(tmp_path, endpoint, sizes, sum(sizes))
        wanted += sum(sizes)
    rows = [r.CERT for r in readers.read_landed_pages(spark, str(tmp_path), FIELDS).collect()]
    assert len(rows) == len(set(rows)) == wanted


@pytest.mark.parametrize(("sizes", "total"), [((4, 0), 7), ((0,), 2), ((6, 3), 8)])
def test_pages_short_of_the_total_or_beyond_it_name_the_endpoint(spark, tmp_path, sizes, total):
    landed(tmp_path, "loans", (5, 1), 6)
    landed(tmp_path, "offices", sizes, total)
    with pytest.raises(readers.IncompletePages, match="offices"):
        readers.read_landed_pages(spark, str(tmp_path), FIELDS)
    assert readers.read_landed_pages(spark, str(tmp_path), FIELDS, check=False).count() == 6 + sum(sizes)


def test_calendar_is_that_of_a_plain_walk_over_days(spark):
    rng = random.Random(23)
    for _ in range(6):
        start = date(1990, 1, 1) + timedelta(days=rng.randrange(12_000))
        today = start + timedelta(days=rng.randrange(1_200))
        days = (start + timedelta(days=k) for k in range((today - start).days + 1))
        ends = [d.strftime("%Y%m%d") for d in days if d.month % 3 == 0 and (d + timedelta(days=1)).month != d.month]
        assert [r.tag for r in readers.quarter_calendar(spark, start, today).orderBy("tag").collect()] == ends


def test_conform_and_schema(spark):
    df = spark.createDataFrame([(1, "x")], "b int, extra string")
    out = readers.conform(df, schemas.struct(a=schemas.TEXT, b=schemas.NUMBER))
    assert out.columns == ["a", "b"] and tuple(out.first()) == (None, 1)
    with pytest.raises(ValueError):
        readers.enforce_schema(df, out.schema)
    first = readers.enforce_schema(spark.sql("SELECT 1 AS a, NULL AS b"), None)
    assert dict(first.dtypes)["b"] == "string"


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = lambda rows: spark.createDataFrame(rows, "k bigint, p string, v double")
    assert writers.keyed_upsert(batch([(1, "a", 1.0), (2, "b", 2.0)]), path, ["k"]) == 2
    for _ in range(2):  # running it again changes nothing
        assert writers.keyed_upsert(batch([(2, "b", 5.0), (3, "b", 3.0)]), path, ["k"]) == 2
        assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a", 1.0), (2, "b", 5.0), (3, "b", 3.0)]
    assert writers.keyed_upsert(batch([]), path, ["k"]) == 0
    with pytest.raises(ValueError):
        writers.keyed_upsert(batch([(1, "a", 1.0), (1, "a", 2.0)]), path, ["k"])
    with pytest.raises(ValueError):
        writers.keyed_upsert(batch([(None, "a", 1.0)]), path, ["k"])
    with pytest.raises(ValueError):
        writers.keyed_upsert(batch([(1, "a", 1.0)]), path, ["missing"])


def test_partitioned_upsert_leaves_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = lambda rows: spark.createDataFrame(rows, "k bigint, v double, p string")
    writers.merge_fact(batch([(1, 1.0, "a"), (2, 2.0, "b")]), path, ["k", "p"], "p")
    before = sorted(f.name for f in (tmp_path / "t" / "p=a").iterdir())
    writers.merge_fact(batch([(2, 9.0, "b"), (3, 3.0, "b")]), path, ["k", "p"], "p")
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, 1.0, "a"), (2, 9.0, "b"), (3, 3.0, "b")]
    assert sorted(f.name for f in (tmp_path / "t" / "p=a").iterdir()) == before


def test_all_key_table_only_inserts(spark):
    a, b = (spark.createDataFrame([(k,) for k in ks], "k bigint") for ks in ((1, 2), (2, 3)))
    assert sorted(r.k for r in writers.merged(a, b, ["k"]).collect()) == [1, 2, 3]


def test_merge_equals_rebuild(spark, tmp_path):
    from quarterdeck.plans import bindings

    fact = bindings.fact(spark, "/root/testdata/sf0.001").select("cert", "report_date", "total_assets", "peer_band")
    path = str(tmp_path / "fact")
    writers.merge_fact(fact.filter("report_date < DATE'1999-01-01'").withColumn("total_assets", F.lit(0.0)), path, ["cert", "report_date"])
    writers.merge_fact(fact, path, ["cert", "report_date"])
    assert spark.read.parquet(path).exceptAll(fact).count() == 0 and spark.read.parquet(path).count() == fact.count()


@pytest.mark.parametrize("fmt", ["yyyyMMdd", "d.M.yyyy"])
def test_new_period_is_told_by_date_not_text(spark, fmt):
    rng = random.Random(31)
    shown = lambda d: d.strftime("%Y%m%d") if fmt == "yyyyMMdd" else f"{d.day}.{d.month}.{d.year}"
    t = lambda days: spark.createDataFrame([(shown(d),) for d in days], "period string")
    for _ in range(4):
        served, held = ([date(2001, 1, 1) + timedelta(days=rng.randrange(9_000)) for _ in range(rng.randrange(1, 5))] for _ in range(2))
        told = lambda a, b, **o: readers.new_period_available(t(a), t(b), "period", fmt, **o)
        assert told(served, held) == (max(served) > max(held)) and not told(held, held)
        assert told([min(served)], served, force=True)
    assert told(served, []) and not told([], held)


def test_catalog(spark):
    served = spark.createDataFrame([("A", "one"), ("B", "other")], "series_id string, series_title string")
    catalog = spark.createDataFrame([("A", "one"), ("B", "two"), ("C", "three")], "series_id string, series_title string")
    assert sorted(r.series_id for r in readers.catalog_mismatches(served, catalog).collect()) == ["B", "C"]
    with pytest.raises(ValueError):
        readers.validate_series_catalog(served, catalog)


def test_extract(spark):
    df = spark.createDataFrame([(1.0, date(2020, 1, 2)), (float("nan"), None)], "v double, d date")
    assert [tuple(r) for r in writers.extract(df).collect()] == [("1.0", "2020-01-02"), ("", "")]
    with pytest.raises(ValueError):
        writers.extract(df, budget=5)


def test_csv_with_byte_order_mark(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes("﻿\"RISDATE\",\"ASSET\"\n\"20200331\",\"12\"\n".encode())
    df = readers.read_export_csv(spark, str(tmp_path / "x.csv"))
    assert df.columns == ["RISDATE", "ASSET"] and tuple(df.first()) == ("20200331", "12")


def test_frozen_copy_is_physical(spark, tmp_path):
    raw = spark.createDataFrame([("20200331",), ("20210331",)], "REPDTE string")
    out = writers.frozen_copy({"f": raw, "g": raw}, date(2020, 12, 31), {"f": ("REPDTE", "yyyyMMdd")}, str(tmp_path))
    assert out["f"].count() == 1 and out["g"].count() == 2 and spark.read.parquet(str(tmp_path / "f")).count() == 1


def test_other_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, True)], "k int, flag boolean")
    writers.truncate_load(df, str(tmp_path / "a"))
    writers.truncate_load(df, str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a")).columns == ["k", "flag", "generated_at"]
    writers.write_exhibit(df, str(tmp_path / "b"))
    assert "1,true" in next((tmp_path / "b").glob("*.csv")).read_text()
    assert readers.ensure_table(spark, schemas.WEEKLY).count() == 0
    assert readers.switched(spark, {}, "own") is None and readers.switched(spark, {"own": str(tmp_path / "a")}, "own").count() == 1
    assert readers.row_count(df) == 1 and readers.max_value(df, "k") == 1


def test_staging_strict_and_lenient(spark):
    raw = readers.conform(spark.createDataFrame([("1", "20200331", "x")], "CERT string, REPDTE string, ASSET string"), schemas.FINANCIALS)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stage_financials(raw).collect()
    inst = readers.conform(spark.createDataFrame([("1", "1", "1/5/2020"), ("2", "0", "12/31/1999"), ("3", None, None)], "CERT string, ACTIVE string, ESTYMD string"), schemas.INSTITUTIONS)
    assert [(r.is_active, r.established_date) for r in staging.stage_institutions(inst).orderBy("cert").collect()] == [(True, date(2020, 1, 5)), (False, date(1999, 12, 31)), (None, None)]
    weekly = spark.createDataFrame([("A", "t", "2020-01-01", "1.5"), ("A", "t", "2020-01-08", ".")], schemas.WEEKLY)
    assert [r.value for r in staging.stage_weekly(weekly).collect()] == [1.5]


def test_stream_catches_up_and_repeats_nothing(spark, tmp_path):
    from quarterdeck.streaming.ingest import upsert_stream

    landed, target, mark = (str(tmp_path / x) for x in ("landed", "target", "mark"))
    rows = lambda x: spark.createDataFrame(x, "k bigint, v double, at bigint")
    rows([(1, 1.0, 1), (1, 2.0, 2)]).write.parquet(landed)
    run = lambda: upsert_stream(spark, landed, rows([]).schema, target, ["k"], mark, "at").awaitTermination()
    run()
    rows([(1, 3.0, 3), (2, 4.0, 3)]).write.mode("append").parquet(landed)
    run()
    run()
    assert sorted(tuple(r) for r in spark.read.parquet(target).collect()) == [(1, 3.0, 3), (2, 4.0, 3)]


def test_upserts_leave_nothing_beside_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda v: spark.createDataFrame([(k, k % 3, v) for k in range(9)], "k int, part int, v string")
    for by in (["part"], None):
        for value in ("old", "new"):
            writers.keyed_upsert(rows(value), path + str(by is None), ["k", "part"], by)
        assert {r.v for r in spark.read.parquet(path + str(by is None)).collect()} == {"new"}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["tFalse", "tTrue"]


def test_a_failed_swap_puts_the_old_table_back(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    with pytest.raises(OSError, match="as it was"):
        writers._swap(spark, str(tmp_path / "never written"), path)
    assert spark.read.parquet(path).count() == 3 and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Session:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "local-cluster[3,2,1024]"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        writers.shared_folder(Session())
    assert writers.shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
