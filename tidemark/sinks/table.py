"""Sinks: lakehouse table, files at a path, console preview.

Table names are resolved like this: the explicit target, else the job's
``target_table``, else the job name.  Three dotted parts are used as they are,
two get the catalog in front, one gets catalog and namespace.

Writes are plain DataFrame writes of one bounded batch, so they scale with the
batch: files are written by the executors in parallel, the driver only commits.
``distribute_by`` rebalances the batch on the listed columns before the write
(the ``rebalance`` hint: clustered by those columns, the same idea as a
table's hash distribution mode).  AQE merges small partitions to the advisory
size, so a micro-batch does not spray tiny files, and splits a partition that
a hot key makes too large, so one key cannot make one write task the whole
batch.

Delivery is at least once by default: a batch replayed after a crash is
appended again.  ``idempotent=True`` tags rows with ``_query_id`` (kept in the
checkpoint, so another checkpoint never meets these rows) and ``_batch_id``, and
a replay replaces the rows with both tags.  In a catalog plugin's table that is
an overwrite by predicate; in Spark's own catalog it replaces the partition with
both tags stated, and at a path it is a dynamic overwrite of that partition, the
least that plain files can replace.  No session setting decides.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..spec import DEFAULT_CATALOG, DEFAULT_NAMESPACE, JobSpec, OutputSpec

QUERY_ID_COLUMN = "_query_id"
BATCH_ID_COLUMN = "_batch_id"
NO_QUERY = "none"      # a batch written outside a stream


def resolve_table_name(target: str = "", *, job_name: str = "", table: str = "",
                       catalog: str = DEFAULT_CATALOG,
                       namespace: str = DEFAULT_NAMESPACE) -> str:
    name = target or table or job_name
    if not name:
        raise ValueError("no table name: give a target, a target_table or a job name")
    parts = name.split(".")
    if len(parts) == 3:
        return name
    if len(parts) == 2:
        return f"{catalog}.{name}"
    if len(parts) == 1:
        return f"{catalog}.{namespace}.{name}"
    raise ValueError(f"table name has more than three parts: {name!r}")


def checkpoint_path(root: str, job_name: str, stream_name: str = "main") -> str:
    """``<root>/checkpoints/<job>/<stream>``: one checkpoint per job and sink."""
    return f"{root.rstrip('/')}/checkpoints/{job_name}/{stream_name}"


def _prepare(df: DataFrame, out: OutputSpec, batch_id: int | None, query_id: str) -> DataFrame:
    if out.distribute_by:
        df = df.hint("rebalance", *list(out.distribute_by))
    if out.idempotent:
        if batch_id is None:
            raise ValueError("idempotent writes need the batch id")
        df = (df.withColumn(QUERY_ID_COLUMN, F.lit(query_id or NO_QUERY))
                .withColumn(BATCH_ID_COLUMN, F.lit(int(batch_id)).cast("bigint")))
    return df


def is_v2(spark: SparkSession, table: str) -> bool:
    """True when the table lives in a catalog plugin (Iceberg and the like), not in
    Spark's own session catalog."""
    catalog = table.split(".")[0] if table.count(".") >= 2 else "spark_catalog"
    return spark.conf.get(f"spark.sql.catalog.{catalog}", None) is not None


def create_table(df: DataFrame, out: OutputSpec, table: str) -> None:
    """An empty table with the frame's columns; its properties hold from the first
    file on.  An idempotent table outside a catalog plugin is partitioned by the
    batch, since only whole partitions can be replaced there."""
    spark = df.sparkSession
    new = spark.createDataFrame([], df.schema).writeTo(table).using(out.format)
    for k, v in (out.options or {}).items():
        new = new.option(k, v)
    for k, v in (out.table_properties or {}).items():
        new = new.tableProperty(k, v)
    if out.idempotent and not is_v2(spark, table):
        new = new.partitionedBy(F.col(QUERY_ID_COLUMN), F.col(BATCH_ID_COLUMN))
    new.create()


def write_batch(df: DataFrame, out: OutputSpec, *, table: str | None = None,
                batch_id: int | None = None, query_id: str = "") -> None:
    """Write one bounded frame to ``out.path`` (when set) or to ``table``."""
    df = _prepare(df, out, batch_id, query_id)
    options = dict(out.options or {})
    if out.path:
        writer = df.write.format(out.format).options(**options)
        if out.idempotent:
            writer = (writer.mode("overwrite").partitionBy(QUERY_ID_COLUMN, BATCH_ID_COLUMN)
                            .option("partitionOverwriteMode", "dynamic"))
        else:
            writer = writer.mode(out.write_mode)
        writer.save(out.path)
        return
    if not table:
        raise ValueError("table sink without a table name")
    spark = df.sparkSession
    mode = "overwrite" if out.idempotent else out.write_mode.lower()
    if mode not in ("append", "overwrite"):
        df.write.format(out.format).options(**options).mode(mode).saveAsTable(table)
        return
    if not spark.catalog.tableExists(table):
        create_table(df, out, table)
    if is_v2(spark, table):
        to = df.writeTo(table)
        for k, v in options.items():
            to = to.option(k, v)
        if out.idempotent:      # by predicate and by name: nothing but this batch's rows can go
            to.overwrite((F.col(QUERY_ID_COLUMN) == F.lit(query_id or NO_QUERY))
                         & (F.col(BATCH_ID_COLUMN) == F.lit(int(batch_id))))
        elif mode == "overwrite":
            to.overwrite(F.lit(True))
        else:
            to.append()
        return
    columns = [f"`{c.name}`" for c in spark.catalog.listColumns(table)]     # both inserts go by position
    if out.idempotent:          # both tags stated: exactly that partition is replaced
        _replace_partition(df, table, columns, query_id or NO_QUERY, int(batch_id))
        return
    (df.select(*columns).write.options(**options).option("partitionOverwriteMode", "static")
       .insertInto(table, overwrite=mode == "overwrite"))


def _replace_partition(df: DataFrame, table: str, columns: list[str], query_id: str, batch_id: int) -> None:
    spark = df.sparkSession
    own = [c for c in columns if c.strip("`") not in (QUERY_ID_COLUMN, BATCH_ID_COLUMN)]
    view = f"tidemark_batch_{uuid.uuid4().hex}"
    df.select(*own).createOrReplaceTempView(view)
    name = query_id.replace("\\", "\\\\").replace("'", "\\'")
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (`{QUERY_ID_COLUMN}` = '{name}', "
                  f"`{BATCH_ID_COLUMN}` = {batch_id}) SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def console_rows(df: DataFrame, n: int | None = None) -> DataFrame:
    """The rows the console sink shows: the first ``n`` of the batch."""
    return df.limit(n or OutputSpec().console_rows)


def table_for(spec: JobSpec) -> str:
    return resolve_table_name(spec.output.target_table, job_name=spec.name,
                              catalog=spec.catalog, namespace=spec.namespace)
