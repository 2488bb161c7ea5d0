"""Contracts of the stored tables and the function that makes a DataFrame meet one."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Contract:
    """Types, NOT NULL columns, defaults, text widths and key of a mart."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    defaults: dict[str, object] = field(default_factory=dict)
    widths: dict[str, int] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of a schema, without a detour through Python."""
    return spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema))


# Columns of the three marts. 32-bit floats of the original contract are
# doubles here, since a 32-bit float is exact only up to 2^24 and sums go beyond.
SUPER_USERS = Contract(
    "activity_super_user_df",
    T.StructType([
        T.StructField("user_id", T.LongType(), False),
        T.StructField("user_type", T.StringType(), False),
        T.StructField("gender", T.StringType(), True),
        T.StructField("friend_cnt", T.IntegerType(), False),
        T.StructField("point", T.DoubleType(), False),
        T.StructField("recency", T.DoubleType(), False),
        T.StructField("frequency", T.DoubleType(), False),
        T.StructField("monetary", T.DoubleType(), False),
        T.StructField("block_cnt", T.IntegerType(), False),
    ]),
    key=("user_id",),
    defaults={
        "friend_cnt": 0,
        "point": 0,
        "frequency": 0,
        "monetary": 0,
        "block_cnt": 0,
    },
    widths={"user_type": 10, "gender": 5},
)

CLUSTERS = Contract(
    "activity_cluster_df",
    T.StructType([
        T.StructField("user_id", T.LongType(), False),
        T.StructField("friend_cnt", T.IntegerType(), False),
        T.StructField("recency", T.DoubleType(), False),
        T.StructField("frequency", T.DoubleType(), False),
        T.StructField("monetary", T.DoubleType(), False),
        T.StructField("block_cnt", T.IntegerType(), False),
        T.StructField("cluster", T.ByteType(), False),
    ]),
    key=("user_id",),
    defaults={
        "friend_cnt": 0,
        "frequency": 0,
        "monetary": 0,
        "block_cnt": 0,
    },
)

TIMESERIES = Contract(
    "activity_timeseries_df",
    T.StructType([
        T.StructField("week_start", T.DateType(), False),
        T.StructField("cluster", T.ByteType(), False),
        T.StructField("week_label", T.StringType(), False),
        T.StructField("revenue", T.LongType(), False),
        T.StructField("active_users", T.IntegerType(), False),
        T.StructField("cum_users", T.IntegerType(), False),
        T.StructField("point_burn", T.DoubleType(), False),
        T.StructField("net_flow", T.DoubleType(), False),
        T.StructField("last_act", T.TimestampType(), True),
        T.StructField("vote_cnt", T.IntegerType(), False),
        T.StructField("vote_user_cnt", T.IntegerType(), False),
        T.StructField("war", T.DoubleType(), False),
        T.StructField("arpu", T.DoubleType(), False),
        T.StructField("votes_per_user", T.DoubleType(), False),
        T.StructField("vote_conversion_rate", T.DoubleType(), False),
        T.StructField("war_status", T.StringType(), False),
        T.StructField("arpu_status", T.StringType(), False),
        T.StructField("vpu_status", T.StringType(), False),
        T.StructField("pure_attendance_cnt", T.IntegerType(), False),
        T.StructField("pure_attendance_rate", T.DoubleType(), False),
        T.StructField("cumulative_net_flow", T.DoubleType(), False),
        T.StructField("cumulative_burn", T.DoubleType(), False),
        T.StructField("vpu", T.DoubleType(), False),
    ]),
    key=("week_start", "cluster"),
    defaults={
        "revenue": 0,
        "active_users": 0,
        "cum_users": 0,
        "point_burn": 0,
        "net_flow": 0,
        "vote_cnt": 0,
        "vote_user_cnt": 0,
        "war": 0,
        "arpu": 0,
        "votes_per_user": 0,
        "vote_conversion_rate": 0,
        "war_status": "",
        "arpu_status": "",
        "vpu_status": "",
        "pure_attendance_cnt": 0,
        "pure_attendance_rate": 0,
        "cumulative_net_flow": 0,
        "cumulative_burn": 0,
        "vpu": 0,
    },
    widths={"week_label": 20, "war_status": 10, "arpu_status": 10, "vpu_status": 10},
)

MARTS: dict[str, Contract] = {c.name: c for c in (SUPER_USERS, CLUSTERS, TIMESERIES)}

SYNC_LOG_TABLE = "pipeline_sync_log"
SYNC_LOG = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("gen", T.IntegerType()),
    T.StructField("batch", T.StringType()),
    T.StructField("schema_json", T.StringType()),
    T.StructField("last_synced_at", T.TimestampType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("updated_at", T.TimestampType()),
])


def _column(contract: Contract, part: T.StructField, enforce: bool, whole_seconds: bool) -> str:
    """SQL of one column: cast, default, and the checks that fail the write."""
    name, kind = part.name, part.dataType.simpleString()
    value = f"cast({name} as {kind})"
    if whole_seconds and kind == "timestamp":
        value = f"date_trunc('second', {value})"
    if name in contract.defaults:
        value = f"coalesce({value}, cast('{contract.defaults[name]}' as {kind}))"
    if enforce and name in contract.widths:
        width = contract.widths[name]
        value = f"if(length({value}) > {width}, raise_error('{contract.name}.{name}: longer than {width}'), {value})"
    if enforce and not part.nullable and name not in contract.defaults:
        value = f"coalesce({value}, cast(raise_error('{contract.name}.{name}: NULL') as {kind}))"
    return f"{value} as {name}"


def conform(
    df: DataFrame, contract: Contract, *, enforce: bool = True, whole_seconds: bool = False
) -> DataFrame:
    """Select, cast and default the contract's columns, in its order.

    With ``enforce`` a NULL in a NOT NULL column or an over-long text fails the write that
    consumes the result: the checks are expressions inside the same stage, not extra jobs.
    ``whole_seconds`` drops fractions of a second from timestamps.
    """
    return df.selectExpr(*(_column(contract, part, enforce, whole_seconds) for part in contract.schema))


def duplicate_keys(df: DataFrame, contract: Contract) -> DataFrame:
    """Keys held by more than one row, with their counts."""
    return df.groupBy(*contract.key).count().where(F.col("count") > 1)
