"""Header, projection and audit operators: one projection each."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import row_sum
from ..run import RunContext


def normalize_headers(df: DataFrame, case: str = "upper", strip: str = "") -> DataFrame:
    """Blanks to underscores and one letter case for every header."""
    names = []
    for name in df.columns:
        for ch in strip:
            name = name.replace(ch, "")
        name = name.replace(" ", "_")
        names.append(name.upper() if case == "upper" else name.lower())
    clash = {n for n in names if names.count(n) > 1}
    if clash:
        raise ValueError(f"headers collide after normalisation: {sorted(clash)}")
    return df.toDF(*names)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def fix_unnamed(df: DataFrame, names: dict[str, str | None]) -> DataFrame:
    """Name unnamed index columns; a target of None drops the column."""
    df = df.withColumnsRenamed({k: v for k, v in names.items() if v is not None})
    return df.drop(*[k for k, v in names.items() if v is None])


def stem_column(columns: list[str], stem: str) -> str:
    """First header that contains the stem."""
    for name in columns:
        if stem in name:
            return name
    raise ValueError(f"no column contains {stem!r}; headers are {columns}")


def canonicalize_by_stem(df: DataFrame, stems: list[str]) -> DataFrame:
    """Rename dated headers such as ``PMS_LOAD_OUT_05-January-23`` to their stems."""
    return df.withColumnsRenamed({stem_column(df.columns, s): s for s in stems})


def date_from_header(df: DataFrame, stem: str, pos: int, fmt: str, name: str = "BOOK_STOCK_DATE") -> DataFrame:
    """Add the day written in a header (token ``pos`` after splitting on ``_``) as yyyyMMdd text."""
    text = stem_column(df.columns, stem).split("_")[pos]
    day = datetime.strptime(text.title(), fmt).strftime("%Y%m%d")
    return df.withColumn(name, F.lit(day))


def apply_contract(df: DataFrame, contract: list[str | Column | tuple[str, str] | tuple[str, str, str]]) -> DataFrame:
    """Ordered projection. Entries are a name, a Column, (source, name) or (source, name, type);
    types are cast tolerantly."""
    cols = []
    for item in contract:
        if isinstance(item, str):
            cols.append(F.col(f"`{item}`"))
        elif isinstance(item, Column):
            cols.append(item)
        elif len(item) == 2:
            cols.append(F.col(f"`{item[0]}`").alias(item[1]))
        else:
            cols.append(F.col(f"`{item[0]}`").try_cast(item[2]).alias(item[1]))
    return df.select(*cols)


def with_audit(df: DataFrame, run: RunContext) -> DataFrame:
    return df.withColumns({
        "RUN_DATE_ID": F.lit(run.run_date_id).cast("int"),
        "INSERT_LOAD_TIME_ID": F.lit(run.load_time_id).cast("bigint"),
        "INSERT_LOAD_TIME": F.lit(run.loaded_at.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp"),
    })


def with_tag(df: DataFrame, name: str, value: str) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def stringify(df: DataFrame, spec: list[str | tuple[str, str]]) -> DataFrame:
    """Text projection for the warehouse edge; nulls stay null."""
    pairs = [(s, s) if isinstance(s, str) else s for s in spec]
    return df.select(*[F.col(a).cast("string").alias(b) for a, b in pairs])


def interactions(df: DataFrame, name: str = "interactions", cols=("favorite_count", "retweets")) -> DataFrame:
    return df.withColumn(name, row_sum(*cols))


def union_all(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
