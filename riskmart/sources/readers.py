"""Reading: CSV, tables, file listings, the load-once ingest."""

from __future__ import annotations

import csv
import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from riskmart.config import AUDIT_COLUMNS
from riskmart.sources import buckets
from riskmart.sources.commits import CommitLog

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, at the price of a second scan.

    With a schema the header must name its columns. A line that does not fit is kept as text if the
    schema has the column ``_corrupt_record``; otherwise the read fails, so nothing turns null unseen.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    names = T.StructType.fromDDL(schema).fieldNames() if isinstance(schema, str) else schema.fieldNames()
    reader = reader.schema(schema).option("enforceSchema", False)
    if CORRUPT in names:
        return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    return reader.option("mode", "FAILFAST").csv(path)


def ingest_audit(df: DataFrame) -> DataFrame:
    """Load time and source file next to otherwise untouched columns."""
    return df.withColumns({"_ingest_ts": F.current_timestamp(), "_source_file": F.col("_metadata.file_path")})


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """True if a table can be read at the path."""
    try:
        return len(spark.read.format(fmt).load(path).columns) > 0
    except AnalysisException:
        return False


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def list_files(spark: SparkSession, paths: str | Sequence[str], pattern: str = "*") -> DataFrame:
    """``path, length`` of the files below a folder; contents are not read."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    return listing.load(paths).select("path", "length")


MANIFEST_SCHEMA = "batch_id string, path string, state string, reason string, modified timestamp"
PLANNED, DONE, SET_ASIDE = "planned", "done", "set aside"


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(MANIFEST_SCHEMA).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], MANIFEST_SCHEMA)


def _record(spark: SparkSession, files: Sequence[str], batch_id: str, state: str, manifest: str) -> None:
    rows = spark.createDataFrame([(batch_id, f, state, None, None) for f in files], MANIFEST_SCHEMA)
    rows.coalesce(1).write.mode("append").parquet(manifest)


class Loaded(NamedTuple):
    """Files loaded by one call and the batch partitions they went to."""

    files: int
    batches: tuple[str, ...]


@dataclass(frozen=True)
class Lease:
    """A loader's name and how long its claim on files holds against other loaders; its own claims it takes up again at once."""

    loader: str
    seconds: float = 6 * 3600


def set_aside(spark: SparkSession, manifest: str) -> DataFrame:
    """``path, reason, modified`` of the files that do not fit the schema and have not been loaded since."""
    rows = _manifest(spark, manifest)
    loaded = rows.filter(F.col("state") == DONE).select("path")
    return rows.filter(F.col("state") == SET_ASIDE).join(loaded, "path", "left_anti").select("path", "reason", "modified")


def _pending(spark: SparkSession, source: str, pattern: str, manifest: str) -> tuple[dict[str | None, list[str]], set[str]]:
    """(files still to load by the batch they were planned for; new ones, and misfits changed since, under ``None``; those misfits).

    A misfit never goes back to its batch: that batch's other files may be loaded, and would be overwritten.
    """
    aside = F.col("state") == SET_ASIDE
    known = _manifest(spark, manifest).groupBy("path").agg(
        F.max_by("batch_id", F.when(~aside, F.col("batch_id"))).alias("batch_id"), F.max(F.col("state") == DONE).alias("done"),
        F.max(F.when(aside, F.col("modified"))).alias("misfit_at"), F.max(aside).alias("misfit"),
    )
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(source)
    unchanged = F.coalesce(F.col("misfit") & (F.col("modificationTime") <= F.col("misfit_at")), F.lit(False))
    # the reader takes file names, so the names of the files still to load are fetched
    pending = (
        listing.select("path", "modificationTime").join(known, "path", "left")
        .filter(~F.coalesce("done", F.lit(False)) & ~unchanged)
        .select("path", "batch_id", F.coalesce("misfit", F.lit(False)).alias("misfit"))
        .collect()
    )
    batches: dict[str | None, list[str]] = {}
    for row in pending:
        batches.setdefault(None if row.misfit else row.batch_id, []).append(row.path)
    return batches, {row.path for row in pending if row.misfit}


def _claimed(
    spark: SparkSession, source: str, pattern: str, manifest: str, lease: Lease
) -> tuple[dict[str, list[str]], list[str]]:
    """(batches to take up again, new files): what no other loader has a living claim on, claimed for this one.

    Claims are entries of a commit log: of two loaders that planned the same files one is first, the other plans again.
    """
    log = CommitLog(f"{manifest.rstrip('/')}.claims")
    while True:
        entries = log.read(spark)
        batches, mended = _pending(spark, source, pattern, manifest)
        now = datetime.now()
        owner: dict[str, tuple[str, str, bool]] = {}  # file -> its batch, loader, alive
        for e in entries:
            claim = json.loads(e.text)
            alive = (now - e.written).total_seconds() < claim["seconds"]
            for batch_id, files in claim["batches"].items():
                owner.update(dict.fromkeys(files, (batch_id, claim["loader"], alive)))
        mine: dict[str, list[str]] = {}
        fresh: list[str] = []
        for batch_id, files in batches.items():
            for f in files:
                planned, loader, alive = owner.get(f, (batch_id, lease.loader, False))
                if alive and loader != lease.loader:
                    continue
                if planned is None or f in mended:
                    fresh.append(f)
                else:
                    mine.setdefault(planned, []).append(f)
        if not mine and not fresh:
            return {}, []
        named = mine | ({uuid.uuid4().hex: fresh} if fresh else {})
        text = json.dumps({"loader": lease.loader, "seconds": lease.seconds, "batches": named})
        if log.append(spark, entries[-1].version if entries else 0, text):
            return mine, [next(iter(named.keys() - mine.keys())), *fresh] if fresh else []


def _plain(path: str) -> str:
    """A file's path in one spelling: listings and the reader's metadata write local paths differently."""
    return re.sub(r"^file:/+", "/", unquote(path))


def _misfits(spark: SparkSession, files: Sequence[str], schema: T.StructType | str | None) -> dict[str, str]:
    """file -> why it does not fit the schema. Reads the files once for their headers and once for their lines."""
    if schema is None:
        return {}
    fields = [f for f in (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields if f.name != CORRUPT]
    wanted, by_plain = [f.name.lower() for f in fields], {_plain(f): f for f in files}
    lines = spark.read.text(list(files)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value", F.monotonically_increasing_id().alias("place")
    )
    headers = lines.filter("start = 0").groupBy("path").agg(F.min_by("value", "place").alias("header")).collect()
    found = {}
    for r in headers:  # one line per file
        names = [n.strip().lower() for n in next(csv.reader([r.header]), [])]
        if names != wanted:
            found[by_plain[_plain(r.path)]] = f"its header is {r.header[:200]}"
    rest = [f for f in files if f not in found]
    if rest:
        checked = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
        reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).schema(checked)
        # the reader parses a column only if it is asked for
        used = F.xxhash64(*[F.col(f"`{f.name}`") for f in fields])
        per_file = reader.csv(rest).groupBy(F.col("_metadata.file_path").alias("path")).agg(
            F.count(CORRUPT).alias("bad"), F.max(used).alias("used"), F.min(CORRUPT).alias("line")
        )
        for r in per_file.filter("bad > 0").collect():
            found[by_plain[_plain(r.path)]] = f"{r.bad} lines do not fit, such as {r.line[:200]}"
    return found


def _put_aside(spark: SparkSession, misfits: dict[str, str], batch_id: str, manifest: str) -> None:
    """Remember misfits with their time of change, so that they are tried again once they are mended."""
    times = {r.path: r.modificationTime for r in spark.read.format("binaryFile").load(list(misfits)).select("path", "modificationTime").collect()}
    rows = [(batch_id, f, SET_ASIDE, reason, times[f]) for f, reason in misfits.items()]
    spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(manifest)


def ingest_once(
    spark: SparkSession,
    source: str,
    table: str,
    manifest: str,
    schema: T.StructType | str | None = None,
    pattern: str = "*",
    fmt: str = "parquet",
    bucketed: buckets.Buckets | None = None,
    set_misfits_aside: bool = False,
    lease: Lease | None = None,
) -> Loaded:
    """Append the files that were not loaded yet; returns what this run loaded.

    A batch is planned in the manifest before it is loaded and marked done after. Its rows go to
    the partition ``_batch=<id>``, which a rerun after a crash overwrites, so nothing is loaded
    twice or lost. A file without rows is remembered as well. Without a schema the first load
    infers the types and later ones keep them. ``bucketed`` (at the path of the table) deals each batch to buckets.

    A file that does not fit the schema fails the load; with ``set_misfits_aside`` it is noted in the manifest with the reason
    (see ``set_aside``), the rest of its batch is loaded, and it is tried again when it has changed. With a ``lease`` several loaders may run
    at once: each file is claimed by one of them, and a loader that died loses its claims when they run out.
    """
    if schema is None and table_exists(spark, table, fmt):
        stored = spark.read.format(fmt).load(table).schema
        schema = T.StructType([f for f in stored.fields if f.name not in (*AUDIT_COLUMNS, "_batch")])
    if lease is None:
        batches, _ = _pending(spark, source, pattern, manifest)
        fresh = batches.pop(None, [])  # the others belong to loads that were interrupted
        batch_id = uuid.uuid4().hex
    else:
        batches, claimed = _claimed(spark, source, pattern, manifest, lease)
        batch_id, fresh = (claimed[0], claimed[1:]) if claimed else ("", [])
    if fresh:
        _record(spark, fresh, batch_id, PLANNED, manifest)
        batches[batch_id] = fresh

    def write(files: Sequence[str], batch_id: str) -> None:
        rows = ingest_audit(read_csv(spark, files, schema)).withColumn("_batch", F.lit(batch_id))
        if bucketed is not None:
            buckets.append(rows, bucketed, batch_id)
            return
        (
            rows.write.format(fmt)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("_batch")
            .save(table)
        )

    loaded: dict[str, list[str]] = {}
    for batch_id, files in batches.items():
        try:
            write(files, batch_id)
        except Exception:
            misfits = _misfits(spark, files, schema) if set_misfits_aside else {}
            if not misfits:  # something else is wrong
                raise
            _put_aside(spark, misfits, batch_id, manifest)
            files = [f for f in files if f not in misfits]
            if not files:
                continue
            write(files, batch_id)
        _record(spark, files, batch_id, DONE, manifest)
        loaded[batch_id] = files
    return Loaded(sum(len(f) for f in loaded.values()), tuple(loaded))


def ingest_load_check(loaded: DataFrame) -> DataFrame:
    """Rows per source file of a loaded table."""
    name = F.element_at(F.split("_source_file", "/"), -1)
    return loaded.groupBy(name.alias("file_name")).agg(F.count(F.lit(1)).alias("n_rows"))


def table_inventory(spark: SparkSession, tables: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """Rows, columns, files and bytes per table, and the total.

    Rows are counted per file first; a parquet count reads footers only.
    """
    per_table = None
    for name, path in tables.items():
        df = spark.read.format(fmt).load(path)
        per_file = df.groupBy(F.col("_metadata.file_path"), F.col("_metadata.file_size").alias("size")).agg(
            F.count(F.lit(1)).alias("n")
        )
        row = per_file.agg(
            F.lit(name).alias("table_name"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
            F.count(F.lit(1)).alias("n_files"),
            F.coalesce(F.sum("size"), F.lit(0)).alias("n_bytes"),
        )
        per_table = row if per_table is None else per_table.unionByName(row)
    total = per_table.agg(
        F.lit("total").alias("table_name"),
        *[F.sum(c).alias(c) for c in ("n_rows", "n_columns", "n_files", "n_bytes")],
    )
    return per_table.unionByName(total)
