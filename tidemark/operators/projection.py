"""Projection, cast and schema operators (P1-P12) — thin DataFrame idioms,
kept as named functions so plans read like the analysis they implement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.quality import numeric_columns


def project_cast(df: DataFrame, spec: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Keep only ``spec`` columns: {source: (type, alias)}."""
    return df.select(*[F.col(c).cast(t).alias(a) for c, (t, a) in spec.items()])


def cast_dates(df: DataFrame, columns: Mapping[str, str], fmt: str | None = None) -> DataFrame:
    """string/timestamp -> 'date' | 'timestamp' | 'timestamp_ntz'; dirty
    strings become null (try_to_timestamp) instead of failing the job."""
    out = {}
    for c, t in columns.items():
        src = F.col(c)
        if dict(df.dtypes)[c] == "string":
            ts = F.try_to_timestamp(src, F.lit(fmt)) if fmt else F.try_to_timestamp(src)
            out[c] = F.to_date(ts) if t == "date" else ts.cast(t)
        else:
            out[c] = src.cast(t)
    return df.withColumns(out)


def cast_numeric(df: DataFrame, columns: Sequence[str], to: str = "double") -> DataFrame:
    """Cast the listed columns (unparseable strings -> null via try_cast)."""
    return df.withColumns({c: F.expr(f"try_cast(`{c}` AS {to})") for c in columns})


def select_numeric(df: DataFrame) -> DataFrame:
    """Keep numeric columns only."""
    return df.select(*numeric_columns(df))


def title_name(name: str) -> str:
    """Python ``str.title`` rule: upper-case each letter after a non-letter."""
    return name.title()


def normalize_names(df: DataFrame, rename: Mapping[str, str] | None = None,
                    keep: Sequence[str] | None = None) -> DataFrame:
    """P5: title-case every column name, apply ``rename`` (e.g. Date ->
    Datetime) and optionally keep a fixed list."""
    names = [title_name(c) for c in df.columns]
    rename = dict(rename or {})
    names = [rename.get(n, n) for n in names]
    out = df.toDF(*names)
    return out.select(*keep) if keep else out


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P6."""
    return df.drop(*columns)


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows with any null (in ``subset``) removed."""
    return df.na.drop(subset=list(subset) if subset else None)


def set_index_sort(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Global sort (range-partitioned, no single-task sort)."""
    return df.orderBy(*by)


def head_k(df: DataFrame, k: int, order: Sequence) -> DataFrame:
    """P10: the first k rows in ``order`` (include a unique tiebreak)."""
    return df.orderBy(*order).limit(k)


def latest_per_series(df: DataFrame, series: str = "series", ts: str = "bar_ts") -> DataFrame:
    """P10 / K3: the last row of each series by a partial max_by aggregation."""
    cols = [c for c in df.columns if c != series]
    return (df.groupBy(series).agg(F.max_by(F.struct(*cols), F.col(ts)).alias("_r"))
            .select(series, "_r.*"))


def log_price(df: DataFrame, column: str = "close", out: str = "log_price") -> DataFrame:
    """Natural log (null for x <= 0); ``exp`` is the inverse."""
    return df.withColumn(out, F.when(F.col(column) > 0, F.log(F.col(column))))


def column_sums(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One aggregation for all column sums, long: (feature, total, keep)."""
    row = df.agg(*[F.sum(c).cast("double").alias(f"_s{i}") for i, c in enumerate(columns)])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"_s{i}").alias("total"))
        for i, c in enumerate(columns)])).alias("s")).select(
        "s.*", (F.col("s.total") != 0).alias("keep"))
