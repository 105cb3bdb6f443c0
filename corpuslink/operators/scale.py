"""Building blocks that keep jobs spread out however the keys are distributed."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

BROADCAST_ROWS = 50_000


def bounded_rows(df: DataFrame, limit: int) -> list | None:
    """The rows when there are at most `limit`, else None; reads limit + 1 rows."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Repartition before heavy per-row work, if the session asks for it.

    `spark.corpuslink.spread` is a number of partitions. It is meant for inputs of a
    few files with few row groups, which would leave cores idle; unset, frames are
    read as they are stored.
    """
    parts = df.sparkSession.conf.get("spark.corpuslink.spread", None)
    return df.repartition(int(parts), *columns) if parts else df


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors see: `spark.checkpoint.dir` of the session.

    Only a local session that names none gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="corpuslink-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Write the frame once to the shared folder and read it back.

    This cuts the lineage and survives lost executors; the new frame also has
    exact sizes, which the optimizer uses to choose joins.
    """
    path = f"{shared_folder(df.sparkSession)}/corpuslink/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_all(*frames: DataFrame) -> list[DataFrame]:
    """Materialise independent frames at the same time."""
    if not frames:
        return []
    with ThreadPoolExecutor(len(frames)) as pool:
        return list(pool.map(materialize, frames))


def by_shuffle(df: DataFrame) -> DataFrame:
    """The frame to be joined by shuffle, however small its file is.

    The optimizer judges a written frame by its file, and repeated values may take a
    hundred times less there than in the memory of the driver that would broadcast them.
    """
    return df.hint("merge")


def once_and_again(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame | None]:
    """Rows whose key occurs once, and those of keys that repeat (None when there are none); null is a key."""
    again = (df.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n"))
             .where("__n > 1").select("__key"))
    if again.isEmpty():
        return df, None
    same = F.col(key).eqNullSafe(F.col("__key"))
    return df.join(again, same, "left_anti"), df.join(again, same, "left_semi")


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """A small driver-side list as a local relation."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    table = pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows],
                                 schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema)


def localize(df: DataFrame, limit: int = BROADCAST_ROWS) -> tuple[DataFrame, list | None]:
    """A frame counted to be small as a broadcast local relation, with its rows.

    Above the limit the frame comes back unchanged, with None: it is then joined
    by shuffle.
    """
    rows = bounded_rows(df, limit)
    if rows is None:
        return df, None
    return F.broadcast(literal_rows(df.sparkSession, rows, df.schema)), rows


def dense_rank_index(df: DataFrame, bucket: Column, order: Sequence[Column],
                     keys: Sequence[str] = (), name: str = "rank",
                     total: str | None = None, weight: str | None = None) -> DataFrame:
    """0-based rank by `order` within `keys`, never sorting a whole key at once.

    `bucket` must grow with `order` and take few values. Rows are numbered
    inside (keys, bucket); the count of all earlier buckets is added. A key that
    holds a large share of the rows is thus spread over its buckets. With
    `weight` the rank is the sum of the weights of all earlier rows.
    """
    keys = list(keys)
    b, n, before = f"__{name}_bucket", f"__{name}_n", f"__{name}_before"
    w = F.col(weight) if weight else F.lit(1)
    df = df.withColumn(b, bucket)
    counts = df.groupBy(*keys, b).agg(F.sum(w).alias(n))
    span = Window.partitionBy(*keys)
    upto = span.orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn(before, F.coalesce(F.sum(n).over(upto), F.lit(0)))
    if total:
        offsets = offsets.withColumn(total, F.sum(n).over(span))
    offsets = offsets.drop(n)
    # Without keys one row per bucket, at most 65,536; else as many as (keys, bucket).
    offsets = by_shuffle(offsets) if keys else F.broadcast(offsets)
    inside = Window.partitionBy(*keys, b).orderBy(*order)
    local = (F.coalesce(F.sum(w).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
             if weight else F.row_number().over(inside) - 1)
    out = df.withColumn(name, local).join(offsets, [*keys, b])
    return out.withColumn(name, F.col(name).cast("bigint") + F.col(before)).drop(b, before)


def seeded_order(cols: Sequence[Column], seed: int | str) -> Column:
    """Reproducible shuffling key: md5 over the identifying columns and a seed."""
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in cols], F.lit(str(seed))))


def shuffled_rank(df: DataFrame, id_cols: Sequence[str], seed: int | str,
                  name: str = "rank", total: str | None = None) -> DataFrame:
    """0-based rank in a seeded random order; ids must be unique."""
    h = f"__{name}_md5"
    df = df.withColumn(h, seeded_order([F.col(c) for c in id_cols], seed))
    bucket = F.conv(F.substring(F.col(h), 1, 4), 16, 10).cast("int")
    order = [F.col(h), *[F.col(c) for c in id_cols]]
    return dense_rank_index(df, bucket, order, name=name, total=total).drop(h)


def rank_within(df: DataFrame, keys: Sequence[str], id_col: str, name: str) -> DataFrame:
    """0-based rank of unique ids within keys, in hash order."""
    h = f"__{name}_hash"
    df = df.withColumn(h, F.xxhash64(id_col))
    bucket = F.shiftright(F.col(h), 54)
    return dense_rank_index(df, bucket, [F.col(h), F.col(id_col)], keys, name).drop(h)


def ordered_ids(df: DataFrame, order: Sequence[str | Column], name: str = "row_id",
                keys: Sequence[str] = (), total: str | None = None,
                weight: str | None = None) -> DataFrame:
    """0-based rank in a given order, over range partitions.

    The range-partitioned rows are written out, so that the partition of each
    row is fixed before partitions are counted.
    """
    p = f"__{name}_partition"
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = materialize(df.repartitionByRange(*[F.col(c) for c in keys], *order)
                         .withColumn(p, F.spark_partition_id()))
    return dense_rank_index(ranged, F.col(p), order, keys, name, total, weight).drop(p)
