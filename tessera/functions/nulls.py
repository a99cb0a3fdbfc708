"""Null rules, coercion and the score link function (#9-12, #18)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def numeric_coerce(df: DataFrame, cols, strict: bool = True, to: str = "double") -> DataFrame:
    """Cast columns to a numeric type. ``strict`` raises on a malformed value (ANSI cast); otherwise the
    value becomes null (``try_cast``). Nulls stay null either way."""
    def conv(c):
        return F.col(c).cast(to) if strict else F.col(c).try_cast(to)
    return df.withColumns({c: conv(c) for c in cols})


def null_fill(df: DataFrame, mapping: dict) -> DataFrame:
    """Replace nulls with a constant per column, e.g. ``{'essay': '', 'teacher_prefix': 'Teacher'}``."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in mapping.items()})


def null_literal(df: DataFrame, cols, literal: str = "nan") -> DataFrame:
    """Stringify columns; a null becomes the text ``nan``."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(literal)) for c in cols})


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def nan_safe_sigmoid(df: DataFrame, col: str, out: str | None = None, fill: str = "zero") -> DataFrame:
    """Map a raw margin to a probability: NaN (and null) margins are replaced first, by 0 (``fill='zero'``,
    giving 0.5) or by the mean margin of the table (``fill='mean'``), then ``1 / (1 + e^-x)``."""
    out = out or col
    x = F.col(col).cast("double")
    if fill == "zero":
        repl = F.lit(0.0)
    elif fill == "mean":
        # One aggregate action; the fitted mean is a single number inlined as a literal.
        m = df.select(F.avg(F.when(~F.isnan(x), x))).first()[0]
        repl = F.lit(float(m) if m is not None else 0.0)
    else:
        raise ValueError(f"fill must be 'zero' or 'mean', not {fill!r}")
    filled = F.coalesce(F.nanvl(x, repl), repl)
    return df.withColumn(out, sigmoid(filled))
