"""Small column expressions shared by the operators. All stay in built-in Spark functions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_yyyymmdd(c: ColumnOrName) -> Column:
    """yyyymmdd number or string to date; malformed values become NULL instead of failing the job."""
    return F.try_to_date(F.lpad(as_col(c).cast("string"), 8, "0"), "yyyyMMdd")


def with_year_month(df: DataFrame, date: str, numeric: bool = True) -> DataFrame:
    """Integer partition columns year and month from a yyyymmdd column (or a date column)."""
    d = parse_yyyymmdd(date) if numeric else F.col(date)
    return df.withColumns({"year": F.year(d), "month": F.month(d)})


def with_calendar(df: DataFrame, date: str) -> DataFrame:
    """year, zero-padded month and day of month."""
    return df.withColumns({
        "year": F.year(date),
        "month": F.lpad(F.month(date).cast("string"), 2, "0"),
        "day": F.dayofmonth(date),
    })


def days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    return F.datediff(as_col(end), as_col(start))


def null_if(c: ColumnOrName, cond: Column) -> Column:
    return F.when(~F.coalesce(cond, F.lit(False)), as_col(c))


def normalise_key(c: ColumnOrName, lower: bool = False) -> Column:
    """Trimmed key. Lower-casing is off by default because ids are case-sensitive."""
    key = F.trim(as_col(c).cast("string"))
    return F.lower(key) if lower else key


def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den, with any denominator that is not positive replaced by 1."""
    d = as_col(den)
    return as_col(num) / F.when(d > 0, d).otherwise(F.lit(1))


def to_number(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Columns as double; what cannot be read as a number, and NULL, become 0."""
    types = dict(df.dtypes)

    def number(c: str) -> Column:
        source = F.col(c).cast("int") if types[c] == "boolean" else F.col(c)
        return F.coalesce(source.try_cast("double"), F.lit(0.0))

    return df.withColumns({c: number(c) for c in cols})


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast a set of columns; values that do not fit become NULL."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def drop_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def fill(df: DataFrame, values: dict[str, object] | None = None) -> DataFrame:
    """Fill by column, or every numeric column with 0 when no map is given."""
    return df.na.fill(values) if values is not None else df.na.fill(0)


def coalesce_category(df: DataFrame, cols: Sequence[str], suffix: str = "_oh") -> DataFrame:
    """Category columns with NULL turned into code 0, under a suffixed name."""
    return df.withColumns({f"{c}{suffix}": F.coalesce(F.col(c), F.lit(0)) for c in cols}).drop(*cols)


def normalise_enum(df: DataFrame, c: str, values: Sequence[str], other: str = "unknown") -> DataFrame:
    """Trim, lower, keep only known values, and add one 0/1 flag per value."""
    clean = F.lower(F.trim(F.col(c)))
    name = f"{c}_norm"
    out = df.withColumn(name, F.when(clean.isin(*values), clean).otherwise(F.lit(other)))
    return out.withColumns({f"{c}_{v}": (F.col(name) == v).cast("int") for v in [*values, other]})


def with_source(df: DataFrame, name: ColumnOrName | None, ingested_at) -> DataFrame:
    """Audit columns. The timestamp is an argument, so a rerun gives the same rows.

    Without a name the file each row came from is recorded.
    """
    source = F.input_file_name() if name is None else (F.lit(name) if isinstance(name, str) else name)
    return df.withColumns({
        "_source_file": source,
        "_ingestion_timestamp": F.lit(ingested_at).cast("timestamp"),
    })


def with_row_id(df: DataFrame, cols: Sequence[str], name: str = "row_id") -> DataFrame:
    """Content hash as row id: equal rows, and only they, get the same id. Each part carries its length; NULL has none."""
    texts = [F.col(c).cast("string") for c in cols]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit(":")) for t in texts]
    return df.withColumn(name, F.sha2(F.concat(*parts), 256))


def stamp_snapshot(df: DataFrame, date: str) -> DataFrame:
    return df.withColumn("snapshot_date", F.lit(date).cast("date"))
