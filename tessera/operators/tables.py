"""Table operations (S4, S11, S12, S14, K1-K16) on Parquet - no Delta needed.

Writes go to Parquet folders; keyed upserts rewrite only the partitions they touch
(dynamic partition overwrite), staging through the shared checkpoint folder first
when source and target are the same path so a failed task never reads a half-written
file.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.windows import dedup_by_key, duplicate_rows, latest_by_key
from tessera.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class TableSpec:
    """A named target: keys, incremental columns, partition columns, write mode."""
    name: str
    path: str
    keys: Sequence[str] = field(default_factory=tuple)
    incremental_cols: Sequence[str] = field(default_factory=tuple)
    partition_by: Sequence[str] = field(default_factory=tuple)
    mode: str = "append"  # append | overwrite | merge
    tenant_col: str | None = "organization_id"
    permit_duplicate_keys: bool = False
    skew_noise_col: str | None = None

    @property
    def merge_keys(self) -> list[str]:
        """What a merge matches on: the effective keys and the incremental columns (a later
        event of a key is a new row, not an update). Empty without keys."""
        return list(dict.fromkeys([*self.effective_keys, *self.incremental_cols])) if self.keys else []

    @property
    def effective_keys(self) -> list[str]:
        """keys + partition columns + tenant, minus the noise column, distinct."""
        ks = list(self.keys) + list(self.partition_by) + ([self.tenant_col] if self.tenant_col else [])
        return [k for k in dict.fromkeys(ks) if k != self.skew_noise_col]


# ------------------------------------------------------------------ reads

def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """True when ``path`` holds a readable table (public reader API: a missing or empty
    folder raises an ``AnalysisException``)."""
    from pyspark.errors import AnalysisException
    try:
        spark.read.format(fmt).load(path).schema  # noqa: B018 - resolves the file listing
        return True
    except AnalysisException:
        return False


def read_table(spark: SparkSession, spec: TableSpec, tenant: str | None = None,
               schema: T.StructType | None = None) -> DataFrame:
    """Current state with the global tenant filter; a missing table is an empty
    frame (of ``schema`` when given)."""
    if not table_exists(spark, spec.path):
        return spark.createDataFrame([], schema or T.StructType([]))
    df = spark.read.option("mergeSchema", "true").parquet(spec.path)
    if tenant is not None and spec.tenant_col and spec.tenant_col in df.columns:
        df = df.filter(F.col(spec.tenant_col) == tenant)
    return df


def read_incremental(spark: SparkSession, spec: TableSpec, from_time, until_time, lag_days: int = 0,
                     tenant: str | None = None) -> DataFrame:
    """Current state filtered to ``[from - lag, until)`` on every incremental column
    (typed filters, I1), partition columns included so folders are pruned."""
    from tessera.operators.incremental import incremental_filters
    df = read_table(spark, spec, tenant)
    if not df.columns:
        return df
    filters = incremental_filters(df.schema, list(spec.incremental_cols), from_time, until_time, lag_days,
                                  partition_cols=list(spec.partition_by))
    for f in filters:
        df = df.filter(f)
    return df


WRITE_LOG_SCHEMA = "run_id string, table string, operation string, rows long, written_at timestamp"


def log_write(spark: SparkSession, log_path: str, run_id: str, table: str, operation: str, rows: int) -> None:
    """S14 producer: one row per write in an append-only Parquet log (our table history)."""
    import datetime as _d
    spark.createDataFrame([(run_id, table, operation, int(rows), _d.datetime.now())], WRITE_LOG_SCHEMA) \
        .write.mode("append").parquet(log_path)


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    """K9: register a folder as a named table in the session catalog (partition folders
    are recovered into the catalog when the table is partitioned)."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{path}'")
    if spark.catalog.getTable(name) is not None and spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter(
            "col_name = '# Partition Information'").count() > 0:
        spark.catalog.recoverPartitions(name)


def write_errors(df: DataFrame, spec: TableSpec, from_col: str = "from_epoch", until_col: str = "until_epoch") -> None:
    """Failed fetches as a second append sink, epochs also as timestamps."""
    d = df
    for c in (from_col, until_col):
        if c in d.columns:
            d = d.withColumn(c.replace("epoch", "ts"), F.timestamp_millis(F.col(c)))
    write_append(d, spec)


# ------------------------------------------------------------------ K4, K5, K7 layout

def stamp(df: DataFrame, run_id: str, snap_ts: Column | None = None, workspace: str | None = None) -> DataFrame:
    """K4: snapshot ts, run id, workspace name in one projection."""
    cols = {"Pipeline_SnapTS": snap_ts if snap_ts is not None else F.current_timestamp(),
            "run_id": F.lit(run_id)}
    if workspace is not None:
        cols["workspace_name"] = F.lit(workspace)
    return df.withColumns(cols)


def layout_for_write(df: DataFrame, spec: TableSpec, front: Sequence[str] = (), noise_buckets: int = 0) -> DataFrame:
    """K7: stats columns first; optional skew noise ``int(rand()*n)`` added to the
    partitioning; rows rebalanced by partition columns (``REBALANCE`` lets AQE split
    large partitions instead of one task per date)."""
    cols = [c for c in front if c in df.columns]
    d = df.select(*cols, *[c for c in df.columns if c not in cols])
    parts = list(spec.partition_by)
    if noise_buckets and spec.skew_noise_col:
        d = d.withColumn(spec.skew_noise_col, (F.rand() * noise_buckets).cast("int"))
        parts.append(spec.skew_noise_col)
    if parts:
        d = d.hint("rebalance", *parts)
    return d


# ------------------------------------------------------------------ writes (K1, K2, K3, K6)

def _writer(df: DataFrame) -> DataFrameWriter:
    """A writer that stores lists of days as differences (mostly one day), not as numbers of a
    dictionary: some bytes a list in place of a byte or more for each day."""
    days = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.DateType)]
    if not days:
        return df.write
    return df.write.options(**{"parquet.writer.version": "v2"}, **{f"parquet.enable.dictionary#{c}.list.element": "false" for c in days})


def write_append(df: DataFrame, spec: TableSpec) -> None:
    """K1: partitioned append; readers merge schemas."""
    w = _writer(df).mode("append")
    if spec.partition_by:
        w = w.partitionBy(*spec.partition_by)
    w.parquet(spec.path)


def _writable(df: DataFrame) -> DataFrame:
    """A table whose only partition is the one without a value reads that column without a
    type; it is written as text (null either way)."""
    return df.withColumns({f.name: F.col(f"`{f.name}`").cast("string") for f in df.schema.fields if isinstance(f.dataType, T.NullType)})


def write_overwrite(df: DataFrame, spec: TableSpec) -> None:
    """K2: full overwrite with the new schema (staged when it reads its own target)."""
    staged = persist_and_reload(_writable(df))
    w = staged.write.mode("overwrite")
    if spec.partition_by:
        w = w.partitionBy(*spec.partition_by)
    w.parquet(spec.path)


def persist_and_reload(df: DataFrame, folder: str | None = None) -> DataFrame:
    """K6: cut a long plan by writing to the shared checkpoint folder and reading back
    (survives executor loss, unlike a local checkpoint)."""
    base = folder or ensure_checkpoint_dir(df.sparkSession)
    path = f"{base.rstrip('/')}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _match(df: DataFrame, other: DataFrame, cols: Sequence[str], how: str) -> DataFrame:
    """``left_semi`` or ``left_anti`` join on ``cols`` where null equals null (an equi-join:
    Spark shuffles null-safe equality by value)."""
    names = {c: f"__m{i}" for i, c in enumerate(cols)}
    cond = F.lit(True)
    for c, m in names.items():
        cond = cond & F.col(c).eqNullSafe(F.col(m))
    return df.join(other.select(*[F.col(c).alias(m) for c, m in names.items()]), cond, how)


def upsert_frame(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 permit_duplicates: bool = False, order: Sequence[str] = ()) -> DataFrame:
    """K3 (+K5) as a plan: source de-duplicated by key (unless duplicates are allowed),
    target rows without a source match kept (left-anti join), then all source rows.
    Matched -> updated, unmatched -> inserted; idempotent, also for keys with a null part
    (null matches null, as the de-duplication has it)."""
    src = source if permit_duplicates else dedup_by_key(source, keys, order)
    return _match(target, src, keys, "left_anti").unionByName(src, allowMissingColumns=True)


def write_upsert(df: DataFrame, spec: TableSpec, derive: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """K3 on Parquet: the source is de-duplicated by the merge key (keys, incremental and
    partition columns, tenant), also on the first write; later writes rewrite only the
    partitions the source touches (dynamic partition overwrite), staged first because
    the target is read and overwritten in one job. Rows without a partition value form a
    partition of their own, which is merged like any other.

    ``derive`` adds the stored columns that follow from others of the row. They are made anew
    as the table is written, for stored rows too, and take no part in the merge before."""
    spark = df.sparkSession
    keys = spec.merge_keys or list(spec.keys)
    derive = derive or (lambda x: x)
    if not table_exists(spark, spec.path):
        write_append(derive(df if spec.permit_duplicate_keys else dedup_by_key(df, keys)), spec)
        return
    tgt = spark.read.option("mergeSchema", "true").parquet(spec.path)
    tgt = tgt.drop(*[c for c in derive(df).columns if c not in df.columns])
    parts = list(spec.partition_by)
    if parts:
        # stored rows of every partition that is about to be replaced, the null one included
        tgt = _match(tgt, df.select(*parts).distinct(), parts, "left_semi")
    _overwrite_partitions(derive(persist_and_reload(_writable(upsert_frame(tgt, df, keys, spec.permit_duplicate_keys)))), spec)


def _overwrite_partitions(staged: DataFrame, spec: TableSpec) -> None:
    """Replace the partitions that ``staged`` holds, and only those (the whole table when
    it has no partition columns)."""
    w = _writer(_writable(staged)).mode("overwrite")
    if spec.partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*spec.partition_by)
    w.parquet(spec.path)


def merge_into_table(source: DataFrame, table: str, keys: Sequence[str], schema_evolution: bool = True,
                     order: Sequence[str] = ()) -> None:
    """K3 on a catalog table that supports row-level MERGE (a V2 table format): the
    source is de-duplicated by key (K5), matched rows are updated, the rest inserted.
    Parquet folders use ``write_upsert`` instead."""
    src = dedup_by_key(source, keys, order).alias("s")
    target = table.split(".")[-1]  # the target is referenced by its table name
    cond = None
    for k in keys:
        c = F.col(f"{target}.{k}") == F.col(f"s.{k}")
        cond = c if cond is None else cond & c
    w = src.mergeInto(f"{table}", cond)
    if schema_evolution:
        w = w.withSchemaEvolution()
    w.whenMatched().updateAll().whenNotMatched().insertAll().merge()


def keep_rows(spark: SparkSession, spec: TableSpec, keep) -> int:
    """Rewrite a stored table to ``keep(df)`` (a filter), touching as little as possible:
    nothing when no row goes, and only the partitions that lose rows. A partition that
    loses all its rows cannot be emptied by a partition overwrite; then the whole table is
    staged and rewritten. Returns the number of rows removed."""
    df = read_table(spark, spec)
    parts = list(spec.partition_by)
    if not parts:
        n = df.count() - keep(df).count()
        if n:
            write_overwrite(keep(df), spec)
        return n
    before = df.groupBy(*parts).agg(F.count(F.lit(1)).alias("__all"))
    after = keep(df).groupBy(*parts).agg(F.count(F.lit(1)).alias("__kept")).withColumnsRenamed({p: f"{p}__k" for p in parts})
    cond = F.lit(True)
    for p in parts:
        cond = cond & F.col(p).eqNullSafe(F.col(f"{p}__k"))
    lost = persist_and_reload(_writable(before).join(after, cond, "left").select(*parts, "__all", F.coalesce("__kept", F.lit(0)).alias("__kept"))
                              .where("__all > __kept"))
    n, empty = lost.agg(F.sum(F.col("__all") - F.col("__kept")), F.count_if(F.col("__kept") == 0)).first()
    if not n:
        return 0
    if empty:
        write_overwrite(keep(df), spec)
    else:
        _overwrite_partitions(persist_and_reload(_match(_writable(keep(df)), lost, parts, "left_semi")), spec)
    return int(n)


def rollback_run(df: DataFrame, run_id: str, run_col: str = "run_id") -> DataFrame:
    """The table without the rows of a failed run (caller rewrites touched parts)."""
    return df.filter(F.col(run_col).isNull() | (F.col(run_col) != run_id))


def rollback_to_time(df: DataFrame, incremental_cols: Sequence[str], from_ms: int, spare: Column | None = None) -> DataFrame:
    """Keep rows whose incremental columns are all before the rollback point; a row
    without such a time is not known to be later and stays, and so do ``spare`` rows."""
    keep = F.lit(True)
    for c in incremental_cols:
        dt = df.schema[c].dataType
        if isinstance(dt, T.LongType):
            early = F.col(c) < F.lit(from_ms)
        elif isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
            early = F.col(c) < F.timestamp_millis(F.lit(from_ms)).cast(dt)
        elif isinstance(dt, T.DateType):
            early = F.col(c) < F.to_date(F.timestamp_millis(F.lit(from_ms)))
        else:
            continue
        keep = keep & F.coalesce(early, F.lit(True))
    return df.filter(keep if spare is None else keep | spare)


def purge_duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Every duplicated key tuple collapses to one copy."""
    return dedup_by_key(df, keys, order)


def get_dups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K12 report: rows whose key tuple occurs more than once."""
    return duplicate_rows(df, keys)


def snapshot_tables(spark: SparkSession, tables: dict[str, str], target_base: str,
                    exclude: Sequence[str] = ()) -> DataFrame:
    """Deep copy of a set of Parquet tables, with a status row per table."""
    rows = []
    for name, src in tables.items():
        if name in exclude:
            rows.append((name, src, None, "SKIPPED"))
            continue
        dst = f"{target_base.rstrip('/')}/{name}"
        try:
            spark.read.parquet(src).write.mode("overwrite").parquet(dst)
            rows.append((name, src, dst, "SUCCESS"))
        except Exception as e:  # report, do not stop the other copies
            rows.append((name, src, dst, f"FAILED: {type(e).__name__}"))
    return spark.createDataFrame(rows, "table string, source string, target string, status string")


def backfill_by_map(df: DataFrame, target_col: str, key_col: str, mapping: dict[str, str]) -> DataFrame:
    """Fill a column from a key -> value map (missing keys keep the old value)."""
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    m = F.create_map(*kv)
    return df.withColumn(target_col, F.coalesce(F.try_element_at(m, F.col(key_col)), F.col(target_col)))


def unpivot_prices(df: DataFrame, ids: Sequence[str], price_cols: dict[str, str], name: str = "sku",
                   value: str = "contract_price") -> DataFrame:
    """Price columns -> one row per SKU (``unpivot``)."""
    d = df.withColumnsRenamed(price_cols)
    return d.unpivot(list(ids), list(price_cols.values()), name, value)


# ------------------------------------------------------------------ S4, S14

def new_files(listing: DataFrame, tracker: DataFrame, bad_records: DataFrame,
              name_col: str = "filename", failed_col: str = "failed") -> DataFrame:
    """Listed files minus (tracked and not failed UNION bad-record files), as a
    distinct ``EXCEPT`` on names, re-joined to the listing's metadata."""
    done = tracker.filter(~F.col(failed_col)).select(name_col).union(bad_records.select(name_col))
    fresh = listing.select(name_col).subtract(done)
    return listing.join(fresh, on=name_col, how="inner")


def latest_write(write_log: DataFrame, table_col: str = "table", ts_col: str = "written_at") -> DataFrame:
    """Newest write entry per table from our append-only write log."""
    return latest_by_key(write_log, [table_col], [ts_col])


def publish_view(spark: SparkSession, name: str, df: DataFrame, columns: Sequence[str] | None = None,
                 order_by: Sequence[str] = (), descending: bool = False) -> None:
    """A named view over a fixed column list, optionally sorted."""
    d = df.select(*columns) if columns else df
    if order_by:
        d = d.orderBy(*[F.col(c).desc() if descending else F.col(c).asc() for c in order_by])
    d.createOrReplaceTempView(name)
