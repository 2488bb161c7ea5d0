"""Two copies of a table compared by checksums, and row by row only where those differ.

Each side is read once and summed into buckets of its key: a count and two order-free sums of row hashes
(a doubled row cancels in neither). Buckets are a parameter, so what is compared first is as small for
any table. Only rows of buckets that differ are read again and matched by key; equal tables end there.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 12
FAULTS = ("lost", "extra", "doubled", "thinned", "changed")


def _hashed(df: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int) -> DataFrame:
    # A null must not hash like the absence of a column.
    nulls = F.concat(*(F.col(c).isNull().cast("int").cast("string") for c in columns))
    return df.withColumns({"_bucket": F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"),
                           "_hash": F.xxhash64(nulls, *columns)})


def _sums() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.bit_xor("_hash").alias("x"),
            F.sum(F.col("_hash").cast("decimal(20,0)")).alias("s")]


def checksums(df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """``_bucket, n, x, s``: one row per bucket that has any."""
    return _hashed(df, keys, columns or df.columns, buckets).groupBy("_bucket").agg(*_sums())


def differing(left: DataFrame, right: DataFrame, level: Sequence[str]) -> DataFrame:
    """Rows of two tables of checksums that are not equal, as ``l`` and ``r``."""
    same = reduce(Column.__and__, (F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in level))
    equal = reduce(Column.__and__, (F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in ("n", "x", "s")))
    return left.alias("l").join(right.alias("r"), same, "full").where(~equal)


def reconcile(source: DataFrame, copy: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """The keys whose rows differ, with ``fault`` and the number of rows on either side.

    ``lost``: the copy lacks the key; ``extra``: it alone has it; ``doubled`` or ``thinned``: it holds more
    or fewer rows of it; ``changed``: as many, with other values. Null keys are compared like any other.
    Columns of the same name are compared; the copy must have those of the source.
    """
    keys, columns = list(keys), source.columns
    parts = [_hashed(df.select(*columns), keys, columns, buckets) for df in (source, copy)]
    sums = [part.groupBy("_bucket").agg(*_sums()) for part in parts]
    # At most ``buckets`` numbers, whatever the tables hold.
    wanted = [row[0] for row in differing(*sums, ["_bucket"]).select(F.coalesce("l._bucket", "r._bucket")).collect()]
    inside = F.col("_bucket").isin(wanted) if wanted else F.lit(False)
    rows = [part.where(inside).groupBy(*keys).agg(*_sums()) for part in parts]
    fault = (
        F.when(F.col("r.n").isNull(), "lost").when(F.col("l.n").isNull(), "extra")
        .when(F.col("r.n") > F.col("l.n"), "doubled").when(F.col("r.n") < F.col("l.n"), "thinned").otherwise("changed"))
    return differing(*rows, keys).select(
        *(F.coalesce(f"l.{k}", f"r.{k}").alias(k) for k in keys), fault.alias("fault"),
        F.coalesce("l.n", F.lit(0)).alias("source_rows"), F.coalesce("r.n", F.lit(0)).alias("copy_rows"))
