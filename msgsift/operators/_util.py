"""Small shared column helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def round_half_up(c: Column, digits: int) -> Column:
    """floor(x*10^d + 0.5) / 10^d - the same IEEE operations in Spark and DuckDB."""
    scale = float(10**digits)
    return F.floor(c * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def pct(num: Column, den: Column, digits: int = 4) -> Column:
    """round((num / den) * 100, digits); 0 when den is 0."""
    return F.when(den == 0, F.lit(0.0)).otherwise(
        round_half_up((num.cast("double") / den.cast("double")) * F.lit(100.0), digits)
    )


def top_n_ranked(df: DataFrame, order: list[Column], n: int, rank_col: str = "rank") -> DataFrame:
    """Global top-n (TakeOrderedAndProject) then a 1..n rank over the n survivors only."""
    top = df.orderBy(*order).limit(n)
    return top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))


def label_order(labels: tuple[str, ...] | list[str], col: str = "label") -> Column:
    return F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(col))


def round_doubles(df: DataFrame, digits: int = 9) -> DataFrame:
    """Round every double column (for engine-independent comparison only)."""
    cols = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            cols.append(round_half_up(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
