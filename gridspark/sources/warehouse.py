"""Managed tables: create, drop, append, replace and look up."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.functions import timefn
from gridspark.operators import grid, upsert
from gridspark.schemas import WAREHOUSE
from gridspark.session import materialize, scratch_path

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def create_table(spark: SparkSession, table: str, database: str = "default") -> str:
    """CREATE TABLE IF NOT EXISTS for a known table; returns the statement."""
    schema, parts = WAREHOUSE[table]
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    ddl = f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}) USING parquet"
    if parts:
        ddl += f" PARTITIONED BY ({', '.join(parts)})"
    spark.sql(ddl)
    return ddl


def create_tables(spark: SparkSession, tables: list[str] | None = None, database: str = "default") -> None:
    for table in tables or WAREHOUSE:
        create_table(spark, table, database)


def drop_tables(spark: SparkSession, tables: list[str] | None = None, database: str = "default",
                execute: bool = False) -> list[str]:
    """The DROP statements; they run only with execute=True."""
    statements = [f"DROP TABLE IF EXISTS {database}.{t}" for t in tables or WAREHOUSE]
    if execute:
        for statement in statements:
            spark.sql(statement)
    return statements


def month_of(ts: Column | str) -> Column:
    return F.trunc(F.col(ts) if isinstance(ts, str) else ts, "month")


def shaped(df: DataFrame, table: str, database: str = "default") -> DataFrame:
    """The columns of a table in its order; a partition column `month` is derived from `ts`."""
    columns = df.sparkSession.table(f"{database}.{table}").columns
    if "month" in columns and "month" not in df.columns:
        df = df.withColumn("month", month_of("ts"))
    return df.select(*[F.col(f"`{c}`") for c in columns])


def time_slice(spark: SparkSession, table: str, after: str, until: str, database: str = "default") -> DataFrame:
    """Rows of `(after, until]`; only the months in question are read."""
    def month(text: str) -> Column:
        return month_of(F.lit(text).cast("timestamp_ntz"))

    rows = spark.table(f"{database}.{table}").where(timefn.half_open("ts", after, until))
    return rows.where(F.col("month").between(month(after), month(until)))


def append(df: DataFrame, table: str, database: str = "default", sort_by: list[str] | None = None) -> None:
    """Append by column name in one job with one commit."""
    rows = shaped(df, table, database)
    if sort_by:
        rows = rows.sortWithinPartitions(*sort_by)
    rows.write.insertInto(f"{database}.{table}")


def grow(df: DataFrame, table: str, database: str = "default") -> list[str]:
    """Add the columns of `df` that a table lacks, creating it if need be; returns the names added. Rows stored before
    have NULL there. A column that exists keeps its type."""
    spark = df.sparkSession
    name = f"{database}.{table}"
    ddl = {f.name: f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields}
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} ({', '.join(ddl.values())}) USING parquet")
        return list(ddl)
    known = {c.lower() for c in spark.table(name).columns}
    added = [c for c in ddl if c.lower() not in known]
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(ddl[c] for c in added)})")
    return added


def append_growing(df: DataFrame, table: str, database: str = "default", new_only: bool = False) -> list[str]:
    """Append rows whose columns may be more or fewer than the table's; absent ones are NULL. Returns the columns added.

    `new_only` leaves out rows that the table holds already, so that a repeated load adds nothing.
    """
    added = grow(df, table, database)
    given = {c.lower(): c for c in df.columns}
    fields = df.sparkSession.table(f"{database}.{table}").schema.fields
    rows = df.select(*[(F.col(f"`{given[f.name.lower()]}`") if f.name.lower() in given else F.lit(None))
                       .cast(f.dataType).alias(f.name) for f in fields])
    (append_new if new_only else append)(rows, table, database)
    return added


def _equal(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def append_new(df: DataFrame, table: str, database: str = "default") -> None:
    """Append the rows that the table does not hold yet, so that a repeated load adds nothing."""
    rows, current = shaped(df, table, database), df.sparkSession.table(f"{database}.{table}")
    rows = rows.join(current, _equal(rows, current, rows.columns), "left_anti")
    materialize(rows, f"new-{table}").write.insertInto(f"{database}.{table}")


def merge_dim(df: DataFrame, table: str, keys: list[str], database: str = "default") -> DataFrame:
    """Upsert a dimension: known keys keep their id and take the new names, new keys get ids after the largest.

    Returns the merged dimension. Ids in facts loaded before stay valid.
    """
    spark = df.sparkSession
    current = spark.table(f"{database}.{table}")
    rest = [c for c in current.columns if c != "id"]
    new = df.select(*rest).dropDuplicates(keys)
    match = _equal(current, new, keys)
    kept = current.join(new, match, "left").select(
        current["id"], *[F.coalesce(new[c], current[c]).alias(c) for c in rest])
    last = current.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    added = new.join(current, match, "left_anti").withColumn("key", F.concat_ws("-", *keys))
    added = grid.dense_ids(added, "key").select((F.col("id") + last).cast("int").alias("id"), *rest)
    merged = materialize(kept.unionByName(added), f"dim-{table}")
    merged.select(*current.columns).write.insertInto(f"{database}.{table}", overwrite=True)
    return merged


def replace_partitions(df: DataFrame, table: str, database: str = "default", cluster: list[str] | None = None) -> None:
    """Overwrite only the partitions present in `df`, which may read the table itself: the rows are written to the shared folder
    first. The overwrite runs in a session of its own, since insertInto takes its mode from the session, not from a
    writer option.

    `cluster` names columns by whose ranges the rows are dealt to files and sorted, partition columns first: each file then
    holds few values of them, and Parquet's statistics let a query on one value pass over most of a partition.
    """
    spark = df.sparkSession
    rows, path = shaped(df, table, database), scratch_path(spark, f"replace-{table}")
    rows.write.mode("errorifexists").parquet(path)
    own = spark.newSession()
    for key, setting in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, setting)
    own.conf.set(OVERWRITE_MODE, "dynamic")
    rows = own.read.schema(rows.schema).parquet(path)
    if cluster:
        rows = rows.repartitionByRange(*cluster).sortWithinPartitions(*cluster)
    rows.write.insertInto(f"{database}.{table}", overwrite=True)
    spark.catalog.refreshTable(f"{database}.{table}")


def upsert_table(new: DataFrame, table: str, keys: list[str], value: str, database: str = "default",
                 order: str | None = None) -> None:
    """Replace values on equal keys and add new keys, touching only the partitions `new` falls into: for facts, months.

    The merged rows are spread by all keys but the time, so that no partition is one task, and stored by ranges of (partition,
    other keys, time), so that a slice of one source reads a few files of a month.
    """
    spark = new.sparkSession
    current = spark.table(f"{database}.{table}")
    parts = WAREHOUSE[table][1] if table in WAREHOUSE else []
    if "month" in parts and "month" not in new.columns:
        new = new.withColumn("month", month_of("ts"))
    if parts:
        # an equality join prunes partitions at run time, but loses those of NULL keys
        lost = reduce(lambda a, b: a | b, [F.col(p).isNull() for p in parts])
        touched = current.join(new.select(*parts).distinct(), parts, "left_semi")
        current = touched.unionByName(current.where(lost))
    keys = [*keys, *[p for p in parts if p not in keys]]
    spread = [k for k in keys if k != "ts"]
    cluster = [*parts, *[k for k in spread if k not in parts], *[k for k in keys if k == "ts"]]
    replace_partitions(upsert.upsert(current, new, keys, value, order, spread), table, database, cluster)


def columns(spark: SparkSession, table: str, database: str = "default") -> list[tuple[str, int, str]]:
    """(name, position from 1, type) of each column."""
    schema = spark.table(f"{database}.{table}").schema
    return [(f.name, i, f.dataType.simpleString()) for i, f in enumerate(schema.fields, start=1)]


def preview(spark: SparkSession, table: str, n: int = 10, database: str = "default") -> DataFrame:
    return spark.table(f"{database}.{table}").limit(n)


def count(spark: SparkSession, table: str, database: str = "default") -> int:
    return spark.table(f"{database}.{table}").count()
