"""The layered tables as partitioned Parquet folders under one root."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from contextlib import ExitStack
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.merge import matched_versions, merge_rows, require_unique
from tidemark.operators.state import last_processed, latest_state
from tidemark.operators.validate import with_missing
from tidemark.schemas import ORIGIN, RAW, STATE, TABLES, TableSpec
from tidemark.session import data_files, folder, listed, materialized
from tidemark.sources import commits, pointers
from tidemark.sources.pointers import Pointer

PACKED = "packed-"
PACKED_BYTES = 128 << 20
"""Files of this size are packed well enough."""
LOAD_ID = re.compile(rf"(?!{PACKED})[\w.-]+")
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class LoadReport:
    """What one load wrote: counted by the write itself, without another pass."""

    target: str
    load_id: str
    rows_loaded: int
    rows_rejected: int
    rows_corrupt: int = 0


def in_partitions(column: str, values: list) -> Column:
    """Partition filter for a list of values that may include null."""
    conditions = []
    present = [v for v in values if v is not None]
    if present:
        conditions.append(F.col(column).isin(present))
    if len(present) < len(values):
        conditions.append(F.col(column).isNull())
    return reduce(Column.__or__, conditions, F.lit(False))


class Tables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def create(self) -> Tables:
        """Create the tables that do not exist yet, as empty folders, and complete stopped upserts.

        Nothing more is needed: every read names the schema and every write has to fit it.
        """
        for name in TABLES:
            place, files = folder(self.spark, self.path(name))
            files.mkdirs(place)
            self.finish(name)
        return self

    def read(self, name: str) -> DataFrame:
        """The whole table with its partition columns, for pruning.

        The state is one row for each pipeline: the newest of what was merged into the table and of
        the pointers that runs have moved.
        """
        return self._state() if name == "state" else self._stored(name)

    def _stored(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name].full_schema).parquet(self.path(name))

    def _state(self) -> DataFrame:
        rows = self._stored("state").select(*STATE.names)
        moves = listed(self.spark, f"{self._pointers()}/*")
        if moves:
            written = self.spark.read.schema(STATE).json(moves).filter("pipeline_name IS NOT NULL")
            rows = rows.unionByName(written)
        return self._laid_out(TABLES["state"], latest_state(rows))

    def _pointers(self) -> str:
        return f"{self.root}/pointers"

    def pointer(self, pipeline_name: str) -> Pointer:
        """Where a pipeline stands: its last move, or what was merged into the state before the first."""
        seen = pointers.read(self.spark, self._pointers(), pipeline_name)
        if seen.processed:
            return seen
        return Pointer(seen.number, last_processed(self._stored("state"), pipeline_name))

    def move_pointer(self, pipeline_name: str, seen: Pointer, processed: date, now: datetime) -> Pointer:
        """Move a pipeline's pointer; see ``pointers.move`` for what happens beside another run."""
        return pointers.move(self.spark, self._pointers(), pipeline_name, seen, processed, now)

    def raw(self, since: date | None = None, until: date | None = None) -> DataFrame:
        """Loaded envelopes, of the ingestion dates from ``since`` to ``until`` if these are given.

        With a bound only the folders of its dates are listed, however many others there are.
        """
        spec, path = TABLES["intake"], self.path("intake")
        if since is None and until is None:
            loaded = self._stored("intake").filter("outcome = 'loaded'")
        else:
            days = {p.rpartition("=")[2]: p for p in listed(self.spark, f"{path}/outcome=loaded/ingestion_date=*")}
            days.pop(NO_VALUE, None)
            low, high = (since or date.min).isoformat(), (until or date.max).isoformat()
            chosen = [p for day, p in sorted(days.items()) if low <= day <= high]
            if chosen:
                loaded = self.spark.read.schema(spec.full_schema).option("basePath", path).parquet(*chosen)
            else:
                loaded = self.spark.createDataFrame([], spec.full_schema)
        return loaded.select(*RAW.names, "ingestion_date", "load_id")

    def rejected(self) -> DataFrame:
        """Quarantined envelopes and what each one lacks."""
        return self.read("intake").filter("outcome = 'rejected'").drop("outcome", "batch", "corrupt")

    def corrupt(self) -> DataFrame:
        """Lines of landed files that are no envelopes, with their files."""
        return self.read("intake").filter("outcome = 'corrupt'").select("load_id", "source_file", "corrupt")

    def months(self) -> list[date]:
        """The months that the curated table has a partition of."""
        names = (path.rpartition("=")[2] for path in listed(self.spark, f"{self.path('curated')}/month=*"))
        return [date.fromisoformat(name) for name in names if name != NO_VALUE]

    def of_load(self, load_id: str) -> DataFrame:
        """What one load stored, with its outcomes. Until the load is packed, only its own folders are listed."""
        return self._of_batch("intake", "load_id", load_id)

    def of_run(self, pipeline_name: str, run_id: str) -> DataFrame:
        """The status rows of one run, listed like the rows of a load."""
        return self._of_batch("status", "run_id", run_id).filter(F.col("pipeline_name") == pipeline_name)

    def _of_batch(self, name: str, column: str, value: str) -> DataFrame:
        spec, path = TABLES[name], self.path(name)
        *outer, _ = spec.partitions
        own = listed(self.spark, "/".join([path, *[f"{c}=*" for c in outer], f"batch={value}"]))
        if own:
            return self.spark.read.schema(spec.full_schema).option("basePath", path).parquet(*own)
        return self._stored(name).filter(F.col("batch").startswith(PACKED) & (F.col(column) == value))

    def files_of(self, load_id: str) -> DataFrame:
        """The landed files of one load and how many rows of each came to which outcome."""
        outcome = F.col("outcome")
        return self.of_load(load_id).groupBy("source_file").agg(
            F.count_if(outcome == "loaded").alias("rows_loaded"),
            F.count_if(outcome == "rejected").alias("rows_rejected"),
            F.count_if(outcome == "corrupt").alias("rows_corrupt"),
        )

    def _laid_out(self, spec: TableSpec, df: DataFrame) -> DataFrame:
        derived = {c: F.expr(expression) for c, expression in spec.derived.items()}
        return df.withColumns(derived).select(*spec.full_schema.names)

    def append(self, name: str, df: DataFrame, replace: bool = False) -> None:
        """Add rows. ``replace`` overwrites exactly the partitions the rows fall into."""
        spec = TABLES[name]
        writer = self._laid_out(spec, df).write.partitionBy(*spec.partitions)
        if replace:
            writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        else:
            writer = writer.mode("append")
        writer.parquet(self.path(name))

    def load(self, landed: DataFrame, load_id: str, replace: bool = False) -> LoadReport:
        """Check every landed envelope and store it as loaded, rejected or corrupt, in one pass.

        ``load_id`` gets its own partitions. A caller that can repeat a load with the same rows and
        id (a stream after a restart) sets ``replace`` to make it idempotent.
        """
        if not LOAD_ID.fullmatch(load_id):
            raise ValueError(f"a load id is made of letters, digits and . _ -, and does not start with {PACKED}: {load_id!r}")
        origin = {f.name: F.lit(None).cast(f.dataType) for f in ORIGIN.fields if f.name not in landed.columns}
        named = {"load_id": F.lit(load_id), "batch": F.lit(load_id)}
        checked = with_missing(landed.withColumns(origin)).withColumns(named)
        counts = Observation()
        is_corrupt, lacks = F.col("corrupt").isNotNull(), F.array_size("missing") > 0
        observed = checked.observe(
            counts,
            F.count_if(~is_corrupt & ~lacks).alias("loaded"),
            F.count_if(~is_corrupt & lacks).alias("rejected"),
            F.count_if(is_corrupt).alias("corrupt"),
        )
        self.append("intake", observed, replace)
        rows = counts.get
        return LoadReport(self.path("intake"), load_id, rows["loaded"], rows["rejected"], rows["corrupt"])

    def pack(self, name: str = "intake", until: date | None = None, keep: Sequence[str] = (), least: int = 2) -> int:
        """Merge the small files of many loads (or runs, for ``status``) into few of each outcome and ingestion date
        (or pipeline).

        Rows keep their ``load_id`` (``run_id``). Ingestion dates after ``until`` stay as they are, so do
        the loads in ``keep`` (a load that may still be repeated), folders with fewer than ``least`` small
        batches, and files of ``PACKED_BYTES`` and more. Returns the number of files that went.
        """
        spec = TABLES[name]
        *outer, _ = spec.partitions
        self.finish(name)
        small: dict[str, list[str]] = {}
        for file, size in data_files(self.spark, self.path(name)).items():
            group, _, batch = file.rpartition("/")[0].rpartition("/batch=")
            day = group.rpartition("ingestion_date=")[2]
            late = until is not None and (day == NO_VALUE or date.fromisoformat(day) > until)
            if size < PACKED_BYTES and batch not in keep and not late:
                small.setdefault(group, []).append(file)
        chosen = [f for files in small.values() if len({f.rpartition("/")[0] for f in files}) >= least for f in files]
        if not chosen:
            return 0
        reader = self.spark.read.schema(spec.full_schema).option("basePath", self.path(name))
        rows = reader.parquet(*[f"{self.path(name)}/{f}" for f in chosen])
        rows = rows.withColumn("batch", F.lit(f"{PACKED}{uuid.uuid4().hex}"))
        packed = rows.hint("rebalance", *outer).sortWithinPartitions(*spec.partitions, spec.schema.names[-1])
        self._replace(name, packed, chosen)
        return len(chosen)

    def upsert(
        self,
        name: str,
        source: DataFrame,
        only_if_newer: str | None = None,
        unique_source: bool = False,
    ) -> list:
        """Merge ``source`` into a keyed table; returns the values of the partitions it touched.

        Parquet has no MERGE. The partitions that hold a source row are read, merged and replaced;
        the others are neither read nor written, and each merged row is written once. A key never
        changes its partition, because the partition column is computed from the key.
        ``unique_source`` skips the repeated-key check for a source that is one row per key by
        construction.
        """
        spec = TABLES[name]
        (partition,) = spec.partitions
        self.finish(name)
        with ExitStack() as stack:
            rows = stack.enter_context(materialized(self._laid_out(spec, source), f"upsert-{name}"))
            if not unique_source:
                require_unique(rows, spec.keys)
            # At most one value per partition folder, which the driver lists anyway.
            touched = [row[0] for row in rows.select(partition).distinct().collect()]
            if touched:
                target = self._stored(name).filter(in_partitions(partition, touched))
                matches = None
                if only_if_newer:
                    # Both sides of the merge ask for them, so they are found once.
                    found = matched_versions(target, rows, spec.keys, only_if_newer)
                    matches = stack.enter_context(materialized(found, f"matches-{name}"))
                merged = merge_rows(target, rows, spec.keys, only_if_newer, matches)
                # Rebalancing packs a partition into few files and splits a hot one.
                self._replace(name, merged.hint("rebalance", partition))
        return touched

    def _pending(self, name: str) -> str:
        return f"{self.root}/_pending-{name}"

    def _replace(self, name: str, rows: DataFrame, files: Sequence[str] | None = None) -> None:
        """Put ``rows`` in the place of the given files, or of all files in the partitions they fall into."""
        pending = self._pending(name)
        rows.write.partitionBy(*TABLES[name].partitions).mode("overwrite").parquet(pending)
        if files is None:
            folders = {f.rpartition("/")[0] for f in data_files(self.spark, pending)}
            files = commits.data_files_of(self.spark, self.path(name), sorted(folders))
        commits.decide(self.spark, pending, files)
        self.finish(name, first=True)

    def finish(self, name: str, first: bool = False) -> bool:
        """Complete a change of the table's files that was decided but not applied; True if there was one.

        Every ``create``, ``upsert`` and ``pack`` begins with this, so that one that was stopped at
        any moment is either complete or has not happened.
        """
        return commits.apply(self.spark, self._pending(name), self.path(name), first)


def create_tables(spark: SparkSession, root: str) -> Tables:
    return Tables(spark, root).create()
