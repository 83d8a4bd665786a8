"""Compaction of a stream's tables: many small batch folders become one folder per day, while the stream runs and readers read.

The stream writes ``alerts``, ``rejects`` and ``stats`` in a folder per batch; a batch is whole once its statistics are there. A compaction writes the
rows of all whole batches, together with what earlier compactions hold of the same days, to a part of its own, lists what it took and made
in a plan, and becomes visible by one entry in the commit log. A reader takes the parts of committed plans and the whole batches that none
of them took. So every row is seen once at every moment:

* before the entry, the batches and older parts are read; after it, the new part is;
* a job that dies before the entry leaves a part that nobody reads;
* a batch that the stream repeats after it was compacted is not read again;
* of two compactions at once one commits, the other finds the log changed and gives up.

``vacuum`` deletes what no reader that started within a grace period can still read. Only names of batches, days and parts reach the driver: the batches
since the last compaction and a few names per day.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from riskmart.sources.commits import CommitLog, folders, remove

#: table -> what its rows are laid out by
SLOTS = {"alerts": "day", "rejects": "unix_date(to_date(received_ts))", "stats": "batch_id div 10000"}
#: what a row without such a value is laid out by
NO_SLOT = -1
Batch = tuple[str, int]
Unit = tuple[str, str, int]  # table, part, slot


@dataclass(frozen=True)
class Snapshot:
    """What is visible: the last log entry, the live units of committed parts, and the whole batches none of them took."""

    version: int
    units: frozenset[Unit]
    open: frozenset[Batch]


@dataclass(frozen=True)
class Prepared:
    """A written part that is not visible yet."""

    part: str
    after: int
    took: tuple[Batch, ...]
    made: tuple[Unit, ...]
    replaced: tuple[Unit, ...] = field(default=())


def _log(root: str) -> CommitLog:
    return CommitLog(f"{root}/compacted/log")


def _part(root: str, table: str, part: str) -> str:
    return f"{root}/compacted/{table}/part={part}"


def _read(spark: SparkSession, path: str, keys: str) -> DataFrame | None:
    """A partitioned table with its partition columns of the given types (names that look like numbers stay text); None if there is none."""
    try:
        found = spark.read.parquet(path).schema
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise
    fixed = T.StructType.fromDDL(keys)
    rest = [f for f in found.fields if f.name not in fixed.fieldNames()]
    return spark.read.schema(T.StructType([*rest, *fixed.fields])).parquet(path)


def _batches(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    return _read(spark, f"{root}/{table}", "stream_id string, batch_id bigint")


def _compacted(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    return _read(spark, f"{root}/compacted/{table}", "part string, slot int")


def _among(names: set[str] | list[str], *columns: str) -> Column:
    """Rows of the named folders. The condition is on partition columns only, so other folders are not opened."""
    return F.concat_ws("/", *[F.col(c).cast("string") for c in columns]).isin(sorted(names)) if names else F.lit(False)


def snapshot(spark: SparkSession, root: str) -> Snapshot:
    entries = _log(root).read(spark)
    units: set[Unit] = set()
    taken: dict[str, list[tuple[int, int]]] = {}
    for e in entries:
        plan = json.loads(e.text)
        units -= {tuple(u) for u in plan["replaced"]}
        units |= {tuple(u) for u in plan["made"]}
        for stream, spans in plan["took"].items():
            taken.setdefault(stream, []).extend(map(tuple, spans))
    stats = _batches(spark, root, "stats")
    whole = [] if stats is None else stats.select("stream_id", "batch_id").distinct().collect()
    fresh = {(r.stream_id, r.batch_id) for r in whole if not any(a <= r.batch_id <= b for a, b in taken.get(r.stream_id, ()))}
    return Snapshot(entries[-1].version if entries else 0, frozenset(units), frozenset(fresh))


def _spans(batches: tuple[Batch, ...]) -> dict[str, list[list[int]]]:
    """Batch numbers per stream as first and last of each run: a plan stays small however many batches it took."""
    out: dict[str, list[list[int]]] = {}
    for stream, number in sorted(batches):
        runs = out.setdefault(stream, [])
        if runs and runs[-1][1] == number - 1:
            runs[-1][1] = number
        else:
            runs.append([number, number])
    return out


def _rows(spark: SparkSession, root: str, table: str, seen: Snapshot, slots: set[int] | None = None) -> tuple[DataFrame | None, DataFrame | None]:
    """(rows of the open batches, rows of the live units), the latter of the given slots only."""
    raw, old = _batches(spark, root, table), _compacted(spark, root, table)
    if raw is not None:
        raw = raw.filter(_among([f"{s}/{b}" for s, b in seen.open], "stream_id", "batch_id"))
    if old is not None:
        live = [f"{part}/{slot}" for name, part, slot in seen.units if name == table and (slots is None or slot in slots)]
        old = old.filter(_among(live, "part", "slot")).drop("part", "slot")
    return raw, old


def read(spark: SparkSession, root: str, table: str, seen: Snapshot | None = None) -> DataFrame:
    """A table of the stream as of now (or of ``seen``), each row once."""
    raw, old = _rows(spark, root, table, seen or snapshot(spark, root))
    if raw is None and old is None:
        raise ValueError(f"the stream at {root} has no table {table}")
    if raw is None or old is None:
        return raw if old is None else old
    return raw.unionByName(old, allowMissingColumns=True)


def prepare(spark: SparkSession, root: str) -> Prepared | None:
    """Write the part of a compaction, without making it visible; None if there is nothing to compact."""
    seen = snapshot(spark, root)
    if not seen.open:
        return None
    part = uuid.uuid4().hex
    made, replaced = [], []
    for table, slot in SLOTS.items():
        raw = _rows(spark, root, table, seen)[0]
        if raw is None:
            continue
        slotted = F.coalesce(F.expr(slot).cast("int"), F.lit(NO_SLOT)).alias("slot")
        touched = {r.slot for r in raw.select(slotted).distinct().collect()}
        old = _rows(spark, root, table, seen, touched)[1]
        rows = raw if old is None else raw.unionByName(old, allowMissingColumns=True)
        # dealt by day; the runtime merges small days into one task and splits large ones
        dealt = rows.select("*", slotted).hint("rebalance", "slot")
        dealt.write.mode("errorifexists").partitionBy("slot").parquet(_part(root, table, part))
        made += [(table, part, s) for s in touched]
        replaced += [u for u in seen.units if u[0] == table and u[2] in touched]
    return Prepared(part, seen.version, tuple(sorted(seen.open)), tuple(sorted(made)), tuple(sorted(replaced)))


def commit(spark: SparkSession, root: str, prepared: Prepared) -> bool:
    """Make a part visible in place of what it took and replaced; False if another compaction was faster."""
    plan = {"part": prepared.part, "took": _spans(prepared.took), "made": prepared.made, "replaced": prepared.replaced}
    return _log(root).append(spark, prepared.after, json.dumps(plan))


def compact(spark: SparkSession, root: str) -> bool:
    """Compact all whole batches; False if there were none or another compaction was faster."""
    prepared = prepare(spark, root)
    return prepared is not None and commit(spark, root, prepared)


def vacuum(spark: SparkSession, root: str, grace_s: float = 24 * 3600) -> int:
    """Delete batches and units that were replaced, and parts that were never committed, more than ``grace_s`` seconds ago; returns how many folders went."""
    before = time.time() - grace_s
    entries = _log(root).read(spark)
    plans = [(json.loads(e.text), e.written.timestamp()) for e in entries]
    gone = []
    for plan, written in plans:
        if written > before:
            continue
        for table in SLOTS:
            for stream, spans in plan["took"].items():
                there = {n for n, _ in folders(spark, f"{root}/{table}/stream_id={stream}")}
                numbers = {f"batch_id={b}" for first, last in spans for b in range(first, last + 1)}
                gone += [f"{root}/{table}/stream_id={stream}/{n}" for n in there & numbers]
        gone += [f"{_part(root, table, part)}/slot={slot}" for table, part, slot in plan["replaced"]]
    committed = {plan["part"] for plan, _ in plans}
    for table in SLOTS:
        for name, changed in folders(spark, f"{root}/compacted/{table}"):
            if name.removeprefix("part=") not in committed and changed < before:
                gone.append(f"{root}/compacted/{table}/{name}")
    for path in gone:
        remove(spark, path)
    return len(gone)
