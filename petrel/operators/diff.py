"""Comparison and audit of tables: equal frames, equivalent columns, repeated rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _same(a: Column, b: Column, kind: str, tolerance: float, relative: bool) -> Column:
    if kind not in NUMBERS:
        return a.eqNullSafe(b)
    if kind in NUMBERS[:4]:
        return a.eqNullSafe(b)
    room = tolerance * F.greatest(F.lit(1.0), F.abs(b)) if relative else F.lit(tolerance)
    return a.eqNullSafe(b) | F.coalesce(F.abs(a - b) <= room, F.lit(False))


def compare_frames(expected: DataFrame, observed: DataFrame, keys: list[str], tolerance: float = 1e-12, relative: bool = False) -> DataFrame:
    """(column, compared, different) for the shared columns of rows joined on keys, and row counts of either side alone."""
    columns = [c for c in expected.columns if c in observed.columns and c not in keys]
    kinds = dict(expected.dtypes)
    a, b = expected.alias("a"), observed.alias("b")
    both = a.join(b, reduce(lambda x, y: x & y, (F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in keys)), "full")
    left, right = F.coalesce(*(F.col(f"a.`{k}`").isNotNull() for k in keys)), F.coalesce(*(F.col(f"b.`{k}`").isNotNull() for k in keys))
    matched = left & right
    out = both.agg(F.count_if(matched).alias("n"), F.count_if(left & ~right).alias("missing"), F.count_if(right & ~left).alias("extra"), *(F.count_if(matched & ~_same(F.col(f"b.`{c}`"), F.col(f"a.`{c}`"), kinds[c], tolerance, relative)).alias(f"d{i}") for i, c in enumerate(columns)))
    rows = [F.struct(F.lit(c).alias("column"), F.col("n").alias("compared"), F.col(f"d{i}").alias("different")) for i, c in enumerate(columns)]
    rows += [F.struct(F.lit(f"<rows {s}>").alias("column"), F.col("n").alias("compared"), F.col(s).alias("different")) for s in ("missing", "extra")]
    return out.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def equivalent_columns(df: DataFrame) -> DataFrame:
    """(one, two) for pairs of columns that are equal in every row, from a single aggregate."""
    kinds = dict(df.dtypes)
    pairs = [(x, y) for i, x in enumerate(df.columns) for y in df.columns[i + 1 :] if (kinds[x] in NUMBERS) == (kinds[y] in NUMBERS)]
    if not pairs:
        return df.sparkSession.range(0).select(F.lit("").alias("one"), F.lit("").alias("two"))
    plain = lambda c: F.col(f"`{c}`") if kinds[c] in NUMBERS else F.col(f"`{c}`").cast("string")
    out = df.agg(F.count(F.lit(1)).alias("n"), *(F.count_if(~plain(x).eqNullSafe(plain(y))).alias(f"d{i}") for i, (x, y) in enumerate(pairs)))
    rows = F.array(*(F.struct(F.lit(x).alias("one"), F.lit(y).alias("two"), F.col(f"d{i}").alias("d")) for i, (x, y) in enumerate(pairs)))
    return out.where("n > 0").select(F.explode(rows).alias("r")).where("r.d = 0").select("r.one", "r.two")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Distinct rows that stand more than once, with their number."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def table_digest(df: DataFrame, order: list[str]) -> DataFrame:
    """One order-free digest of a table: row digests are summed, so no task sees all rows."""
    row = F.conv(F.substring(F.sha2(F.concat_ws("\x1f", *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x00")) for c in order)), 256), 1, 12), 16, 10).cast("decimal(20,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(row).alias("digest"))


def ordered_digest(df: DataFrame, order: list[str]) -> DataFrame:
    """The MD5 of a table's cells in row order. A report table's rows meet in one task; corpora have ``table_digest``."""
    line = F.concat_ws(",", *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns))
    rows = df.agg(F.sort_array(F.collect_list(F.struct(*(F.col(f"`{c}`") for c in order), line.alias("line__")))).alias("r"))
    return rows.select(F.md5(F.array_join(F.transform("r", lambda x: x["line__"]), "\n")).alias("digest"))


def scope(expected: dict[str, DataFrame], observed: dict[str, DataFrame]) -> list[tuple[str, str]]:
    """(sheet, status) of every expected sheet: identical, different or missing; and of those beyond them: extra."""
    out = [(k, "missing" if k not in observed else "identical" if identical(df, observed[k]) else "different") for k, df in expected.items()]
    return out + [(k, "extra") for k in observed if k not in expected]


def identical(expected: DataFrame, observed: DataFrame) -> bool:
    return expected.columns == observed.columns and expected.exceptAll(observed).isEmpty() and observed.exceptAll(expected).isEmpty()
