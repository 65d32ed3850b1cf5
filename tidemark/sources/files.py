"""Readers and writers (S1, S2, S6): explicit schemas, overwrite semantics,
partitioned layouts.  Paths are parameters; on a cluster they live in the
shared folder (see ``tidemark.session.shared_dir``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

BAR_SCHEMA = StructType([
    StructField("series", StringType()), StructField("bar_ts", TimestampNTZType()),
    StructField("open", DoubleType()), StructField("high", DoubleType()),
    StructField("low", DoubleType()), StructField("close", DoubleType()),
    StructField("volume", LongType())])


#: Names under which price files give the bar columns, in any case.
_NAMES = {"date": "bar_ts", "datetime": "bar_ts", "time": "bar_ts", "adj close": "adj_close",
          "symbol": "series", "ticker": "series"}
_STAMP = "yyyy-MM-dd[['T'][' ']HH:mm:ss[.SSSSSS]]"


def read_bars(spark: SparkSession, path: str, schema: StructType = BAR_SCHEMA, fmt: str = "csv",
              header: bool = True, series: str | None = None) -> DataFrame:
    """Read a bar table under a declared schema (no inference job).

    Columns of a CSV file with a header are found by name, whatever their order
    and case (``Date``, ``Open``, ..., ``Adj Close`` included): a missing one
    raises, an ``adj_close`` is kept, others are dropped.  ``series`` names the
    one series of a file without such a column.  Without a header the columns
    come in the schema's order."""
    if fmt != "csv":
        return spark.read.schema(schema).format(fmt).load(path)
    if not header:
        return spark.read.schema(schema).option("timestampNTZFormat", _STAMP).csv(path)
    raw = spark.read.option("header", True).csv(path)
    names = {_NAMES.get(c.strip().lower(), c.strip().lower()): c for c in raw.columns}
    out = []
    for f in [*schema.fields, StructField("adj_close", DoubleType())]:
        if f.name in names:
            text = F.col(f"`{names[f.name]}`")
            out.append((F.to_timestamp_ntz(text, F.lit(_STAMP)) if isinstance(f.dataType, TimestampNTZType)
                        else text.cast(DoubleType()).cast(f.dataType) if isinstance(f.dataType, LongType)
                        else text.cast(f.dataType)).alias(f.name))
        elif f.name == "series" and series is not None:
            out.append(F.lit(series).alias("series"))
        elif f.name != "adj_close":
            raise ValueError(f"{path}: no column for {f.name} among {raw.columns}")
    return raw.select(*out)


def read_bars_checked(spark: SparkSession, path: str, schema: StructType = BAR_SCHEMA,
                      sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """S1 for files that may hold bad lines: (bars, rejected lines).

    ``path``: CSV files whose first lines name the schema's columns in order.  A
    line with another number of fields, or a field that isn't empty and can't be
    read as its column's type, is in ``line, reason, file`` of the second frame,
    once for each time it stands there; every other line is a bar.  Lines are read
    as text, so quoted fields must not hold line ends."""
    names = [f.name for f in schema.fields]
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))
    head = sep.join(names)
    lines = lines.where((F.col("line") != head) & (F.trim("line") != ""))
    texts = StructType([*[StructField(n, StringType()) for n in names], StructField("_bad", StringType())])
    parsed = lines.withColumn("t", F.from_csv("line", texts.simpleString()[7:-1].replace(":", " "), {
        "sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    cast, wrong = [], []
    for f in schema.fields:
        text = F.nullif(F.trim(F.col(f"t.{f.name}")), F.lit(""))
        value = (F.try_to_timestamp(text, F.lit(_STAMP)).cast(f.dataType) if isinstance(f.dataType, TimestampNTZType)
                 else text.try_cast("double").try_cast(f.dataType) if isinstance(f.dataType, LongType)
                 else text.try_cast(f.dataType))
        cast.append(value.alias(f.name))
        wrong.append(F.when(text.isNotNull() & value.isNull(), F.lit(f.name)))
    fields = F.array_compact(F.array(*wrong))
    reason = F.when(F.col("t._bad").isNotNull(), F.lit("fields")).when(
        F.size(fields) > 0, F.concat(F.lit("not readable: "), F.array_join(fields, ", ")))
    rows = parsed.select("line", "file", reason.alias("reason"), *cast)
    return rows.where("reason IS NULL").select(*names), rows.where("reason IS NOT NULL").select("line", "reason", "file")


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: Sequence[str] = (), mode: str = "overwrite",
                header: bool = True) -> None:
    """Write without an index column; partitioned when asked."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", header).option("timestampNTZFormat",
                                               "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_run(df: DataFrame, path: str, partition_by: Sequence[str], run: str) -> bool:
    """S2 for jobs that may be killed and started again: partitions of ``df``
    replace those of the same values below ``path``, others stay.

    The rows are computed once, into a staging folder of the run; they are moved
    into place by dynamic partition overwrite, and the run's manifest (partitions
    and rows) is written last.  A run whose manifest is there is not written again
    (returns False); one that was killed goes on from its staging folder, or from
    ``df`` if that is not complete.  Readers of ``path`` see neither folder."""
    spark = df.sparkSession
    staging, manifest = f"{path}/_staging/run={run}", f"{path}/_manifest/run={run}"
    if _complete(spark, manifest):
        return False
    if not _complete(spark, staging):
        df.write.mode("overwrite").parquet(staging)
    rows = spark.read.schema(df.schema).parquet(staging)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    rows.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("n_rows")).write.mode("overwrite").parquet(manifest)
    fs, p = _fs(spark, staging)
    fs.delete(p, True)
    return True


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _complete(spark: SparkSession, folder: str) -> bool:
    fs, p = _fs(spark, f"{folder}/_SUCCESS")
    return fs.exists(p)


def write_metrics(report: DataFrame, path: str, run_ts=None) -> None:
    """An evaluation report stamped with its run time (by default now), in a
    partition of its own that writing it again replaces."""
    stamp = F.current_timestamp() if run_ts is None else F.lit(run_ts)
    run = report.sparkSession.range(1).select(F.date_format(stamp, "yyyyMMdd_HHmmss").alias("t")).first()["t"]
    write_run(report.withColumn("run_ts", F.lit(run)), path, ["run_ts"], run)
