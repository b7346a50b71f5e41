"""Parquet storage of the warehouse tables.

Facts are partitioned by tenant and by a bucket of interval ids, dimensions by
tenant. A merge or a retention run therefore reads and rewrites only the
partitions its rows fall into, never a whole fact table.

Load dates do not follow from interval ids, so a zone map holds the first and
last load date of every file of a fact. Files never change: only those that the
map does not know yet are measured, and windows over load dates scan no
partition that lies before them.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from plandrift import schemas as S
from plandrift.functions.columns import AsOf, ago, partition_bucket, start_of_day
from plandrift.functions.filters import since_days
from plandrift.schemas import Table


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        current = tempfile.mkdtemp(prefix="plandrift-")
        spark.sparkContext.setCheckpointDir(current)
    return current


@dataclass(frozen=True)
class Telemetry:
    """The base tables as DataFrames; every view and report starts from these."""

    runtime: DataFrame
    waits: DataFrame
    intervals: DataFrame
    queries: DataFrame
    texts: DataFrame
    plans: DataFrame
    regressions: DataFrame
    run_log: DataFrame
    #: Where the facts are stored, and the facts as read from there.
    warehouse: Warehouse | None = None
    stored: tuple[DataFrame, DataFrame] | None = None

    def loaded_since(self, fact: str, as_of: AsOf, days: int) -> DataFrame:
        """Rows of ``runtime`` or ``waits`` loaded in the last ``days`` days.

        Of a stored fact only partitions with such rows are scanned; a frame that
        was derived or narrowed since is filtered as it is.
        """
        frame = getattr(self, fact)
        for table, name, own in zip((S.RUNTIME, S.WAIT), ("runtime", "waits"), self.stored or ()):
            if fact == name and frame is own:
                frame = self.warehouse.read(table, self.warehouse.loaded_since(table, as_of, days))
        return since_days(frame, "LoadDate", as_of, days)


def lay_out(df: DataFrame, table: Table) -> DataFrame:
    """Arrange rows for writing: few files per partition, clustered by key.

    ``rebalance`` lets adaptive execution cut an oversized tenant into several
    tasks and merge small ones, so one large tenant does not become one task.
    """
    if table.bucket:
        df = df.withColumn(table.bucket[0], partition_bucket(table))
    inner = [c for c in ("ServerName", "DatabaseName", "QueryId", "PlanId") if c in df.columns]
    return df.hint("rebalance", *[F.col(p) for p in table.partitions]).sortWithinPartitions(
        *table.partitions, *inner
    )


#: Zone maps by table path, with the files that they were made from.
_zones: dict[str, tuple] = {}


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: Table) -> str:
        return f"{self.root}/{table.name}"

    def _filesystem(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def exists(self, table: Table) -> bool:
        fs, path = self._filesystem(self.path(table))
        return fs.exists(path)

    def read(
        self, table: Table, partitions: Iterable[tuple] | None = None, stored: bool = False
    ) -> DataFrame:
        """The table's columns; ``partitions`` restricts the scan to those values.

        Plans come with their last execution from the activity table; ``stored``
        leaves them as they were appended.
        """
        schema = table.schema
        if table.bucket:
            schema = T.StructType([*schema.fields, T.StructField(table.bucket[0], T.IntegerType())])
        if not self.exists(table):
            return self.spark.createDataFrame([], table.schema)
        df = self.spark.read.schema(schema).parquet(self.path(table))
        if partitions is not None:
            partitions = list(partitions)
            df = df.filter(self._partition_predicate(table, partitions))
        df = df.select(*table.columns)
        if table is S.PLAN and not stored and self.exists(S.PLAN_ACTIVITY):
            last = self.read(S.PLAN_ACTIVITY).withColumnRenamed("LastExecutionTime", "_last")
            if partitions is not None:
                last = last.filter(F.col("TenantName").isin(sorted({tenant for tenant, *_ in partitions})))
            latest = F.coalesce("_last", "LastExecutionTime").alias("LastExecutionTime")
            df = df.join(last, S.PLAN_KEY, "left").select(
                *[latest if c == "LastExecutionTime" else F.col(c) for c in table.columns]
            )
        return df

    def within(self, df: DataFrame, table: Table, partitions: Iterable[tuple], inside: bool = True) -> DataFrame:
        """Rows of ``df`` that belong into the given partitions, or that do not."""
        if table.bucket:
            df = df.withColumn(table.bucket[0], partition_bucket(table))
        match = self._partition_predicate(table, partitions)
        df = df.filter(match if inside else ~match)
        return df.drop(table.bucket[0]) if table.bucket else df

    @staticmethod
    def _partition_predicate(table: Table, partitions: Iterable[tuple]):
        """Static predicate on the partition columns; tenants with equal buckets share a term."""
        buckets_of: dict[str, list] = {}
        for tenant, *bucket in partitions:
            buckets_of.setdefault(tenant, []).extend(bucket)
        tenants_of: dict[tuple, list] = {}
        for tenant, buckets in buckets_of.items():
            tenants_of.setdefault(tuple(sorted(buckets)), []).append(tenant)
        predicate = F.lit(False)
        for buckets, tenants in sorted(tenants_of.items()):
            match = F.col("TenantName").isin(sorted(tenants))
            if table.bucket:
                match = match & F.col(table.bucket[0]).isin(list(buckets))
            predicate = predicate | match
        return predicate

    def touched(self, df: DataFrame, table: Table) -> list[tuple]:
        """Partition values that occur in ``df``: one entry per stored folder."""
        columns = [F.col("TenantName")] + ([partition_bucket(table)] if table.bucket else [])
        return sorted(tuple(r) for r in df.select(*columns).distinct().collect())

    def stored(self, table: Table) -> list[tuple]:
        """Partition values that the table has, from its folders alone."""
        if not self.exists(table):
            return []
        fs, path = self._filesystem(self.path(table))
        unescape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        folders = [(status.getPath(), ()) for status in fs.listStatus(path) if status.isDirectory()]
        for depth, name in enumerate(table.partitions):
            found = []
            for folder, values in folders:
                key, _, value = folder.getName().partition("=")
                if key != name:
                    continue
                values = (*values, unescape(value) if depth == 0 else int(value))
                below = fs.listStatus(folder) if depth + 1 < len(table.partitions) else []
                found += [(s.getPath(), values) for s in below if s.isDirectory()] or [(folder, values)]
            folders = found
        return sorted({values for _, values in folders if len(values) == len(table.partitions)})

    def append(self, table: Table, df: DataFrame) -> None:
        self._write(table, df, "append")

    def create(self, table: Table, df: DataFrame) -> None:
        self._write(table, df, "overwrite", "static")

    def replace_partitions(self, table: Table, df: DataFrame) -> None:
        """Replace exactly the partitions that ``df`` has rows for.

        New files are complete before any old partition is swapped out, so
        ``df`` may itself read from the table. A run that dies during the swap
        is repaired by repeating it, since merges and retention are idempotent.
        """
        self._write(table, df, "overwrite", "dynamic")

    def compact(self, table: Table, most_files: int = 16) -> list[tuple]:
        """Rewrite partitions of more files than that, as appends leave one or more each.

        Returns the partitions rewritten; their rows stay the same.
        """
        if not self.exists(table):
            return []
        fs, _ = self._filesystem(self.path(table))
        path_of = self.spark._jvm.org.apache.hadoop.fs.Path
        crowded = []
        for values in self.stored(table):
            files = fs.listStatus(path_of(f"{self.path(table)}/{self._folder(table, values)}"))
            if sum(status.getPath().getName().startswith("part-") for status in files) > most_files:
                crowded.append(values)
        if crowded:
            self.replace_partitions(table, self.read(table, crowded, stored=True))
        return crowded

    def _folder(self, table: Table, values: tuple) -> str:
        escape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        return "/".join(f"{name}={escape(str(value))}" for name, value in zip(table.partitions, values))

    def drop_partitions(self, table: Table, partitions: Iterable[tuple]) -> None:
        """Delete whole partitions: an overwrite never touches an emptied one."""
        for values in partitions:
            fs, path = self._filesystem(f"{self.path(table)}/{self._folder(table, values)}")
            fs.delete(path, True)

    def _write(self, table: Table, df: DataFrame, mode: str, overwrite: str = "static") -> None:
        (
            lay_out(df.select(*table.columns), table)
            .write.mode(mode)
            .option("partitionOverwriteMode", overwrite)
            .partitionBy(*table.partitions)
            .parquet(self.path(table))
        )

    def zones(self, table: Table) -> dict[tuple, tuple]:
        """Partition values to the first and last load date of their rows.

        One row per file is stored below ``_zones``. Spark's own listing of the table
        tells which files there are; those not known yet are measured, by their
        ``LoadDate`` alone, and what is gone leaves the map.
        """
        if not self.exists(table):
            return {}
        path, folder = self.path(table), f"{self.root}/_zones/{table.name}"
        relative = lambda file: unquote(file).rpartition(f"/{table.name}/")[2]
        live = {relative(file) for file in self.read(table).inputFiles()}
        known, spans = _zones.get(path, (None, {}))
        if known == live:
            return spans
        fs, root = self._filesystem(folder)
        versions = sorted(s.getPath().getName() for s in fs.listStatus(root)) if fs.exists(root) else []
        columns = "File string, TenantName string, Bucket int, FirstLoad timestamp, LastLoad timestamp"
        rows = self.spark.read.schema(columns).parquet(f"{folder}/{versions[-1]}").collect() if versions else []
        kept = [tuple(row) for row in rows if row.File in live]
        found = {row[0] for row in kept}
        missing = [f"{path}/{name}" for name in sorted(live - found)]
        if missing:
            schema = T.StructType([*table.schema.fields, T.StructField(table.bucket[0], T.IntegerType())])
            new = self.spark.read.schema(schema).option("basePath", path).parquet(*(missing if kept else [path]))
            kept += [(relative(row.File), *row[1:]) for row in new.groupBy(
                F.col("_metadata.file_path").alias("File"), "TenantName", table.bucket[0]
            ).agg(F.min("LoadDate"), F.max("LoadDate")).collect()]
        if missing or len(kept) < len(rows):
            # A new version is complete before an old one goes; readers use the last.
            version = f"{int(versions[-1].split('-')[0]) + 1 if versions else 0:012d}-{uuid.uuid4().hex}"
            self.spark.createDataFrame(kept, columns).coalesce(1).write.parquet(f"{folder}/{version}")
            for old in versions[:-2]:
                fs.delete(self._filesystem(f"{folder}/{old}")[1], True)
        spans = {}
        for _, tenant, bucket, first, last in kept:
            low, high = spans.get((tenant, bucket), (first, last))
            spans[tenant, bucket] = (min(low, first), max(high, last))
        _zones[path] = (live, spans)
        return spans

    def loaded_since(self, table: Table, as_of: AsOf, days: int) -> list[tuple]:
        """Partitions with rows loaded in the last ``days`` days before ``as_of``."""
        cutoff = self.spark.range(1).select(ago(start_of_day(as_of), days, "day")).first()[0]
        return sorted(values for values, (_, last) in self.zones(table).items() if last >= cutoff)

    def telemetry(self, intervals: DataFrame | None = None) -> Telemetry:
        """All tables; with ``intervals`` the facts' scans are cut to their buckets.

        For reports over a window of interval dates: pass the window's rows of the
        interval table. Facts keep whole buckets, so the report still filters.
        """
        def facts(table: Table) -> DataFrame:
            return self.read(table, None if intervals is None else self.touched(intervals, table))

        runtime, waits = facts(S.RUNTIME), facts(S.WAIT)
        own = {} if intervals is not None else {"warehouse": self, "stored": (runtime, waits)}
        return Telemetry(
            runtime=runtime,
            waits=waits,
            **own,
            intervals=self.read(S.INTERVAL),
            queries=self.read(S.QUERY),
            texts=self.read(S.QUERY_TEXT),
            plans=self.read(S.PLAN),
            regressions=self.read(S.REGRESSION),
            run_log=self.read(S.RUN_LOG),
        )
