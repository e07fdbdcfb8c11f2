"""Stored tables, exports and incremental ingest."""

import csv

import pytest
from pyspark.sql import functions as F

from rentscope import schemas
from rentscope.operators import metrics, segments
from rentscope.plans import jobs
from rentscope.sinks import files, versions, warehouse
from rentscope.sources import documents
from rentscope.streaming import ingest


def transactions(spark, n=200):
    return spark.range(n).select(
        F.concat(F.lit("d"), (F.col("id") % 3).cast("string")).alias("district"),
        F.lit("x").alias("building_type"),
        (F.col("id") % 17 + 1.0).alias("area_ping"),
        (F.col("id") * 10 + 5000).alias("rent_ntd"),
        (F.col("id") % 29 * 10.0 + 200).alias("rent_per_ping"),
        F.lit("2026-04-27").cast("date").alias("transaction_date"),
    )


def test_published_versions(spark, tmp_path):
    root = str(tmp_path / "w")
    first = warehouse.publish({"a": spark.range(3), "b": spark.range(5)}, root)
    assert first == {"a": 3, "b": 5}
    assert warehouse.current(spark, root, "b").count() == 5
    warehouse.publish({"a": spark.range(1), "b": spark.range(2)}, root)
    assert warehouse.current(spark, root, "a").count() == 1
    spark.range(9).write.parquet(f"{root}/halfway/a")
    assert warehouse.current(spark, root, "b").count() == 2


def test_metrics_pipeline(spark, tmp_path):
    root = str(tmp_path / "w")
    told = jobs.run_metrics(transactions(spark), root)
    assert (told["transactions"], told["district_metrics"], told["recommendations"]) == (200, 3, 3)
    assert told["kmeans_clusters"] == 4
    clusters = warehouse.current(spark, root, "rental_clusters")
    assert clusters.agg(F.sum("sample_size")).first()[0] == 200
    few = jobs.run_metrics(transactions(spark, 3), str(tmp_path / "few"))
    assert few["kmeans_clusters"] == 0


def test_load_and_snapshots(spark, tmp_path):
    path = str(tmp_path / "t")
    assert warehouse.save_transactions(transactions(spark), path) == 200
    assert documents.load_transactions(spark, path).columns == documents.TRANSACTION_COLUMNS
    assert documents.load_points(spark, path).columns == ["district", "area_ping", "rent_per_ping"]
    stored = documents.stored_rows(spark, path)
    found = metrics.district_metrics(stored)
    clusters, _ = segments.segment(stored)
    out = str(tmp_path / "out")
    files.export_snapshots(found, metrics.recommendations(found), clusters, stored, out)
    read = documents.read_json(spark, f"{out}/district_metrics", schemas.METRICS, multi_line=False)
    assert read.count() == 3 and read.filter("updated_at is null").isEmpty()
    summary = spark.read.json(f"{out}/transactions_summary").first()
    assert summary.total_transactions == 200 and summary.districts == ["d0", "d1", "d2"]


def test_csv_is_flat_and_marked(spark, tmp_path):
    df = spark.sql("select 1 as a, array('x', 'é\"y') as b, named_struct('k', 1) as c, ' s ' as d")
    files.write_csv(df, str(tmp_path / "c"))
    (part,) = (tmp_path / "c").glob("part-*")
    assert part.read_bytes().startswith(b"\xef\xbb\xbfa,b")
    rows = list(csv.DictReader(part.read_text(encoding="utf-8-sig").splitlines()))
    assert rows == [{"a": "1", "b": '["x","é\\"y"]', "c": '{"k":1}', "d": " s "}]


def test_incremental_append(spark, tmp_path):
    folder, table, progress = (str(tmp_path / n) for n in ("in", "table", "progress"))
    rows = transactions(spark).withColumn("source", F.lit("s")).coalesce(1)
    for expected in (200, 400):
        rows.write.mode("append").csv(folder, header=True)
        ingest.append_new_files(spark, folder, table, progress)
        assert documents.stored_rows(spark, table).count() == expected
    ingest.append_new_files(spark, folder, table, progress)
    assert documents.stored_rows(spark, table).count() == 400
    assert documents.stored_rows(spark, table).filter("ingested_at is null").isEmpty()


def test_replace_from_itself(spark, tmp_path):
    path = str(tmp_path / "own")
    warehouse.save_transactions(transactions(spark), path)
    again = documents.stored_rows(spark, path).drop("ingested_at").limit(50)
    assert warehouse.save_transactions(again, path) == 50
    assert documents.stored_rows(spark, path).count() == 50


def ids(spark, path, version=None):
    return sorted(r.rent_ntd for r in documents.load_transactions(spark, path, version).collect())


def test_readers_are_pinned(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "pinned")
    rows = transactions(spark, 60)
    warehouse.save_transactions(rows.where("rent_ntd < 5400"), path)
    first, opened = versions.newest(spark, path), documents.load_transactions(spark, path)
    warehouse.save_transactions(rows.where("rent_ntd >= 5400"), path, replace=False)
    assert len(ids(spark, path)) == 60 and len(ids(spark, path, first)) == 40

    def lost(*_):
        raise ConnectionError("the driver is gone")

    # A replacement whose rows are all written, but that is not committed.
    with monkeypatch.context() as broken:
        broken.setattr(versions, "_commit", lost)
        with pytest.raises(ConnectionError):
            warehouse.save_transactions(rows.where("rent_ntd < 5100"), path)
    assert len(ids(spark, path)) == 60
    # Rows that fail half-way.
    with pytest.raises(Exception, match="rent_ntd is missing"):
        warehouse.save_transactions(rows.withColumn("rent_ntd", F.when(F.col("rent_ntd") < 5500, F.col("rent_ntd"))), path)
    assert len(ids(spark, path)) == 60
    warehouse.save_transactions(rows.where("rent_ntd < 5100"), path)
    assert len(ids(spark, path)) == 10 and len(ids(spark, path, first)) == 40 and opened.count() == 40
    with pytest.raises(FileNotFoundError):
        versions.read(spark, path, 0)


def test_a_repeated_load_adds_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "keys")
    rows = transactions(spark, 30)
    warehouse.save_transactions(rows, path, key="base")
    commit = versions._commit

    def answer_lost(*given):
        commit(*given)
        raise ConnectionError("committed, but nobody knows")

    with monkeypatch.context() as broken:
        broken.setattr(versions, "_commit", answer_lost)
        with pytest.raises(ConnectionError):
            warehouse.save_transactions(rows.limit(7), path, replace=False, key="seven")
    assert warehouse.save_transactions(rows.limit(7), path, replace=False, key="seven") == 7
    assert documents.stored_rows(spark, path).count() == 37
    warehouse.save_transactions(rows.limit(3), path, key="three")
    # The key of a load that was replaced since is still known.
    assert warehouse.save_transactions(rows.limit(7), path, replace=False, key="seven") == 7
    assert documents.stored_rows(spark, path).count() == 3


def test_two_writers_of_one_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "two")
    rows = transactions(spark, 20)
    warehouse.save_transactions(rows, path)
    newest, late = versions.newest, []

    def overtaken(session, table):
        found = newest(session, table)
        if not late:
            late.append(True)
            warehouse.save_transactions(rows.limit(5), path, replace=False)
        return found

    monkeypatch.setattr(versions, "newest", overtaken)
    warehouse.save_transactions(rows.limit(4), path, replace=False)
    assert newest(spark, path) == 3 and documents.stored_rows(spark, path).count() == 29


def test_manifest_of_a_version(spark, tmp_path):
    path = tmp_path / "parts"
    warehouse.save_transactions(transactions(spark, 40).repartition(3), str(path))
    warehouse.save_transactions(transactions(spark, 9).limit(0), str(path), replace=False)
    warehouse.save_transactions(transactions(spark, 9), str(path), replace=False)
    told = versions.parts(spark, str(path)).collect()
    assert sum(r.rows for r in told) == 49 and all(r.bytes > 0 for r in told)
    assert versions.damaged(spark, str(path)).count() == 0
    gone = next(path.glob(f"loads/{told[0].load}/{told[0].file}"))
    gone.write_bytes(b"PAR1")
    assert [r.file for r in versions.damaged(spark, str(path)).collect()] == [told[0].file]
