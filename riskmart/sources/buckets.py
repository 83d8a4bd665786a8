"""Tables bucketed by their key: rows of one key are in one bucket file of every delivery, so that deduplication by key and joins of two
such tables need no shuffle. A delivery is dealt to the buckets once, when it is written; earlier deliveries stay as they are.

How a table is bucketed is written next to its files and cannot be changed: a session that names another key or number of buckets is refused. The
catalog entry follows from that file, so it can be made anew in any session, also where the catalog is not kept.

A bucket is read by one task. Choose as many buckets as make each a few hundred megabytes at the expected size, and keep to plain tables where
single keys may hold a large share of all rows.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from riskmart.sources.commits import folders, publish

BATCH = "_batch"


@dataclass(frozen=True)
class Buckets:
    """A table of parquet files at ``path``, in ``number`` buckets by ``key``, with a partition per delivery."""

    path: str
    key: str
    number: int

    @property
    def name(self) -> str:
        """Its name in the catalog, which follows from where it is."""
        return f"bucketed_{hashlib.md5(self.path.encode()).hexdigest()[:16]}"

    @property
    def spec_path(self) -> str:
        return f"{self.path.rstrip('/')}.buckets/spec.json"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _spec(spark: SparkSession, table: Buckets) -> dict | None:
    try:
        row = spark.read.text(table.spec_path, wholetext=True).first()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None
    return json.loads(row.value)


def _columns(schema: T.StructType) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != BATCH])


def _register(spark: SparkSession, table: Buckets) -> T.StructType:
    """Make the catalog entry, with all deliveries that are there; returns the columns."""
    spec = _spec(spark, table)
    if spec is None:
        raise ValueError(f"no bucketed table at {table.path}")
    if (spec["key"], spec["number"]) != (table.key, table.number):
        raise ValueError(f"{table.path} has {spec['number']} buckets by {spec['key']}, not {table.number} by {table.key}")
    schema = T.StructType.fromJson(spec["schema"])
    if not spark.catalog.tableExists(table.name):
        fields = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table.name} ({fields}, {BATCH} STRING) USING parquet PARTITIONED BY ({BATCH}) "
            f"CLUSTERED BY ({_quoted(table.key)}) INTO {table.number} BUCKETS LOCATION '{table.path}'"
        )
    if folders(spark, table.path):
        spark.sql(f"ALTER TABLE {table.name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(table.name)
    return schema


def append(rows: DataFrame, table: Buckets, batch: str) -> None:
    """Write a delivery: its rows are dealt to the buckets, one file each. Written again, it replaces itself and nothing else."""
    spark = rows.sparkSession
    wanted = _columns(rows.schema)
    publish(spark, table.spec_path, json.dumps({"key": table.key, "number": table.number, "schema": wanted.jsonValue()}))
    stored = _register(spark, table)
    missing, unknown = set(stored.fieldNames()) - set(wanted.fieldNames()), set(wanted.fieldNames()) - set(stored.fieldNames())
    if missing or unknown:
        raise ValueError(f"the delivery lacks {sorted(missing)} and adds {sorted(unknown)}")
    view = f"delivery_{hashlib.md5(f'{table.path}/{batch}'.encode()).hexdigest()[:16]}"
    dealt = rows.select(*[F.col(_quoted(f.name)) for f in stored.fields]).repartition(table.number, F.col(_quoted(table.key)))
    dealt.createOrReplaceTempView(view)
    try:
        value = batch.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"INSERT OVERWRITE TABLE {table.name} PARTITION ({BATCH}='{value}') SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def read(spark: SparkSession, table: Buckets) -> DataFrame:
    """All deliveries, as a scan by bucket."""
    _register(spark, table)
    return spark.table(table.name)


def exists(spark: SparkSession, table: Buckets) -> bool:
    return _spec(spark, table) is not None
