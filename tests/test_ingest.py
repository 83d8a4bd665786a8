import threading
import time

import pytest
from pyspark.sql import functions as F

from riskmart.sources import catalog, commits, readers, writers


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path


def put(folder, name, text):
    (folder / "in" / name).write_text(text)


def load(spark, folder, schema=None):
    return readers.ingest_once(spark, str(folder / "in"), str(folder / "t"), str(folder / "m"), schema)


def test_each_file_is_loaded_once_even_when_empty(spark, folder):
    put(folder, "a.csv", "k,v\n1,x\n2,y\n")
    put(folder, "empty.csv", "k,v\n")
    assert load(spark, folder, "k int, v string").files == 2
    assert load(spark, folder, "k int, v string") == (0, ())
    put(folder, "b.csv", "k,v\n3,z\n")
    assert load(spark, folder, "k int, v string").files == 1
    table = readers.read_table(spark, str(folder / "t"))
    assert sorted(r.k for r in table.collect()) == [1, 2, 3]
    assert {(r.file_name, r.n_rows) for r in readers.ingest_load_check(table).collect()} == {("a.csv", 2), ("b.csv", 1)}
    assert table.filter("_ingest_ts IS NULL").count() == 0


@pytest.mark.parametrize("lost", ["before the data", "after the data"])
def test_an_interrupted_load_is_finished_not_repeated(spark, folder, monkeypatch, lost):
    put(folder, "a.csv", "k,v\n1,x\n")
    real = readers._record

    def crash(spark_, files, batch_id, state, manifest):
        if lost == "after the data" and state == "done":
            raise RuntimeError("driver lost")
        real(spark_, files, batch_id, state, manifest)
        if lost == "before the data" and state == "planned":
            raise RuntimeError("driver lost")

    monkeypatch.setattr(readers, "_record", crash)
    with pytest.raises(RuntimeError):
        load(spark, folder, "k int, v string")
    monkeypatch.setattr(readers, "_record", real)
    put(folder, "b.csv", "k,v\n2,y\n")
    assert load(spark, folder, "k int, v string").files == 2
    assert sorted(r.k for r in readers.read_table(spark, str(folder / "t")).collect()) == [1, 2]
    assert load(spark, folder, "k int, v string").files == 0


def test_later_loads_keep_the_first_types(spark, folder):
    put(folder, "a.csv", "k,v\n1,x\n")
    load(spark, folder)
    put(folder, "b.csv", "k,v\n2.5,y\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|CAST|parse|Malformed"):
        load(spark, folder)
    assert readers.read_table(spark, str(folder / "t")).count() == 1


def test_misfits_are_kept_when_asked(spark, folder):
    put(folder, "a.csv", "k,v\n1,x\nbad,y\n")
    rows = readers.read_csv(spark, str(folder / "in"), "k int, v string, _corrupt_record string").cache()
    assert [(r.k, r._corrupt_record) for r in rows.orderBy("v").collect()] == [(1, None), (None, "bad,y")]


def test_inference(spark, folder):
    put(folder, "a.csv", "k,v,s\n1,2.5,x\n")
    assert dict(readers.read_csv(spark, str(folder / "in")).dtypes) == {"k": "int", "v": "double", "s": "string"}


def test_table_existence(spark, folder):
    assert not readers.table_exists(spark, str(folder / "absent"))
    spark.range(3).write.parquet(str(folder / "there"))
    assert readers.table_exists(spark, str(folder / "there"))


def test_overwrite_replaces_rows_and_schema(spark, folder):
    path = str(folder / "p")
    writers.write_partitioned(spark.range(1000).withColumn("part", F.lit("a")), path, "part")
    writers.write_partitioned(spark.range(10).select("id", F.lit(1).alias("extra"), F.lit("b").alias("part")), path, "part")
    back = readers.read_table(spark, path)
    assert back.columns == ["id", "extra", "part"] and back.count() == 10


def test_export_reads_in_order(spark, folder):
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("k"), F.lit("x").alias("v"))
    writers.export_csv(df.repartition(8), str(folder / "many"), ["k"])
    files = sorted((folder / "many").glob("*.csv"))
    keys = [int(line.split(",")[0]) for f in files for line in f.read_text().splitlines()[1:]]
    assert keys == list(range(500))
    writers.export_csv(df, str(folder / "one"), [F.col("k").desc()], single_file=True)
    (only,) = (folder / "one").glob("*.csv")
    assert only.read_text().splitlines()[1] == "499,x"


def test_run_metrics(spark, folder):
    path = str(folder / "metrics")
    for run in ("r1", "r2"):
        writers.append_run_metrics(writers.run_metrics(spark, run, "s", {"n": 3, "name": "x"}), path)
    got = {(r.run_id, r.metric, r.value, r.detail) for r in spark.read.parquet(path).collect()}
    assert ("r1", "n", 3.0, None) in got and ("r2", "name", None, "x") in got and len(got) == 4


def test_inventory_counts_bytes(spark, folder):
    spark.range(100).repartition(2).write.parquet(str(folder / "x"))
    rows = {r.table_name: r for r in readers.table_inventory(spark, {"x": str(folder / "x")}).collect()}
    size = sum(f.stat().st_size for f in (folder / "x").glob("*.parquet"))
    assert (rows["x"].n_rows, rows["x"].n_columns, rows["x"].n_files, rows["x"].n_bytes) == (100, 1, 2, size)
    assert rows["total"].n_bytes == size


# --------------------------------------------------------------------------- misfits and several loaders


def careful(spark, folder, loader=None, seconds=3600.0, schema="k int, v string"):
    lease = None if loader is None else readers.Lease(loader, seconds)
    return readers.ingest_once(spark, str(folder / "in"), str(folder / "t"), str(folder / "m"), schema, set_misfits_aside=True, lease=lease)


def keys(spark, folder):
    return sorted(r.k for r in readers.read_table(spark, str(folder / "t")).collect())


@pytest.mark.parametrize("loader", [None, "a"])
def test_misfits_are_set_aside_and_tried_again_when_mended(spark, folder, loader):
    put(folder, "good.csv", "k,v\n1,x\n2,y\n")
    put(folder, "value.csv", "k,v\n3,x\nbad,y\n")
    put(folder, "header.csv", "k,w\n4,x\n")
    put(folder, "columns.csv", "k,v,z\n5,x,1\n")
    put(folder, "empty.csv", "k,v\n")
    put(folder, "with space.csv", '"k","v"\n6,"x, y"\n')
    assert careful(spark, folder, loader).files == 3
    assert keys(spark, folder) == [1, 2, 6]
    aside = {r.path.rsplit("/", 1)[1]: r.reason for r in readers.set_aside(spark, str(folder / "m")).collect()}
    assert set(aside) == {"value.csv", "header.csv", "columns.csv"} and "bad,y" in aside["value.csv"] and "k,w" in aside["header.csv"]
    assert careful(spark, folder, loader) == (0, ())
    time.sleep(1.1)  # times of change are compared
    put(folder, "value.csv", "k,v\n3,x\n")
    put(folder, "new.csv", "k,v\n7,x\n")
    assert careful(spark, folder, loader).files == 2
    assert keys(spark, folder) == [1, 2, 3, 6, 7]
    assert readers.set_aside(spark, str(folder / "m")).count() == 2


def test_a_batch_of_misfits_only(spark, folder):
    put(folder, "a.csv", "k,v\nbad,x\n")
    assert careful(spark, folder) == (0, ()) and readers.set_aside(spark, str(folder / "m")).count() == 1


def test_other_failures_are_not_taken_for_misfits(spark, folder, monkeypatch):
    put(folder, "a.csv", "k,v\n1,x\n")
    monkeypatch.setattr(readers, "ingest_audit", lambda df: (_ for _ in ()).throw(RuntimeError("disk full")))
    with pytest.raises(RuntimeError, match="disk full"):
        careful(spark, folder)


def test_two_loaders_load_each_file_once(spark, folder):
    for i in range(12):
        put(folder, f"f{i}.csv", f"k,v\n{i},x\n")
    results, start = {}, threading.Barrier(2)

    def run(name):
        start.wait()
        results[name] = careful(spark, folder, name)

    threads = [threading.Thread(target=run, args=(n,)) for n in ("a", "b")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sum(r.files for r in results.values()) == 12
    assert keys(spark, folder) == list(range(12))


def test_a_dead_loader_loses_its_claim(spark, folder, monkeypatch):
    put(folder, "a.csv", "k,v\n1,x\n")
    real = readers._record

    def crash(spark_, files, batch_id, state, manifest):
        if state == readers.DONE:
            raise RuntimeError("driver lost")
        real(spark_, files, batch_id, state, manifest)

    monkeypatch.setattr(readers, "_record", crash)
    with pytest.raises(RuntimeError):
        careful(spark, folder, "a")
    monkeypatch.setattr(readers, "_record", real)
    put(folder, "b.csv", "k,v\n2,x\n")
    assert careful(spark, folder, "b").files == 1  # a's claim on a.csv lives
    log = commits.CommitLog(f"{folder}/m.claims")
    assert len(log.read(spark)) == 2
    monkeypatch.setattr(readers, "datetime", type("Later", (), {"now": staticmethod(lambda: __import__("datetime").datetime.now() + __import__("datetime").timedelta(hours=2))}))
    assert careful(spark, folder, "b").files == 1  # it has run out
    assert keys(spark, folder) == [1, 2]
    assert careful(spark, folder, "a") == (0, ())


# --------------------------------------------------------------------------- tables by name


def test_a_failed_overwrite_leaves_the_old_table(spark, folder):
    table = catalog.NamedTable("named_a", str(folder / "named"))
    assert not catalog.exists(spark, table)
    with pytest.raises(ValueError):
        catalog.read(spark, table)
    catalog.overwrite(spark.range(10), table)
    failing = spark.range(100).withColumn("id", F.when(F.col("id") == 70, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        catalog.overwrite(failing, table)
    assert spark.table("named_a").count() == 10 and catalog.exists(spark, table)
    catalog.overwrite(spark.range(3).withColumn("part", F.col("id") % 2), table, "part")
    assert spark.table("named_a").columns == ["id", "part"] and spark.table("named_a").count() == 3
    assert catalog.drop_versions(spark, table) == 0 and catalog.drop_versions(spark, table, -5) == 2
    spark.sql("DROP VIEW named_a")
    assert catalog.exists(spark, table) and catalog.read(spark, table).count() == 3


def test_of_two_writers_one_is_told(spark, folder, monkeypatch):
    table = catalog.NamedTable("named_b", str(folder / "named"))
    catalog.overwrite(spark.range(1), table)
    real = commits.CommitLog.append

    def late(self, spark_, after, text):
        monkeypatch.setattr(commits.CommitLog, "append", real)
        catalog.overwrite(spark_.range(2), table)
        return real(self, spark_, after, text)

    monkeypatch.setattr(commits.CommitLog, "append", late)
    with pytest.raises(catalog.Overtaken):
        catalog.overwrite(spark.range(3), table)
    assert catalog.read(spark, table).count() == 2
