"""Test tables as the logical tables of the service, and parameters that fit their dates."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import AnalysisWindow, MartConfig, TableConfig, Tier
from ..operators.cleaning import attendance_days, clean_users
from ..operators.clusters import ClusterModel, score
from ..operators.profile import activity_summary, general_users, user_profile
from ..operators.sketches import active_user_weeks
from ..operators.timeseries import user_weeks
from ..schemas import Contract
from ..session import ensure_session
from ..sources.files import FileSource, read_table, zoned

# The events cover January 2024; the window starts on a Wednesday.
CONFIG = MartConfig(
    window=AnalysisWindow(date(2024, 1, 3), date(2024, 1, 30)),
    super_votes=18,
    outlier_votes=6,
    vpu=Tier(3, 2),
)
# An earlier run of the same marts, and a threshold that both runs can reach.
EARLY = replace(CONFIG, window=AnalysisWindow(date(2024, 1, 3), date(2024, 1, 17)), super_votes=8)
LATE = replace(CONFIG, super_votes=8)

MARK = datetime(2024, 1, 15)
NEXT_MARK = datetime(2024, 1, 25)

# A stored model, so that the KPI queries do not hang on a fit. By position: recency, then
# log counts of friends, votes, payments, blocks.
MODEL = ClusterModel(
    means=(10.0, 1.0, 1.0, 1.0, 1.0),
    deviations=(8.0, 0.6, 6.0, 6.0, 6.0),
    centers=(
        (1.9, -0.9, 0.0, 0.0, 0.0),
        (-1.1, -0.9, 0.1, 0.1, 0.1),
        (1.9, 0.7, 0.0, 0.0, 0.0),
        (0.3, -0.9, 0.0, 0.0, 0.0),
        (-1.1, 0.7, 0.1, 0.1, 0.1),
        (0.3, 0.7, 0.0, 0.0, 0.0),
    ),
)


# A short code for the whole text of a segment; a text that is none of them shows as such.
_SEGMENT = ("case c_mktsegment when 'AUTOMOBILE' then 'auto' when 'BUILDING' then 'build' when 'FURNITURE' then 'furn'"
            " when 'HOUSEHOLD' then 'house' when 'MACHINERY' then 'mach' else 'other' end")
_K = "cast(get_json_object(props, '$.k') as int)"


class Bound:
    """The logical tables over one folder of test tables; each file is opened once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = ensure_session(spark), folder

    @cached_property
    def events(self) -> DataFrame:
        return zoned(read_table(self.spark, self.folder, "events"))

    def _typed(self, kind: str) -> DataFrame:
        return self.events.where(F.col("event_type") == kind).withColumnsRenamed(
            {"event_id": "id", "ts": "created_at"})

    @cached_property
    def users(self) -> DataFrame:
        return read_table(self.spark, self.folder, "customer").selectExpr(
            "c_custkey as id",
            f"if(c_custkey % 31 = 0, null, {_SEGMENT}) as gender",
            "if(c_custkey % 37 = 0, null, c_nationkey) as group_id",
            "cast(round(c_acctbal * 100) as bigint) * 105 as point",
            "cast(c_custkey % 50 = 0 as int) as is_staff",
            "cast(c_custkey % 53 = 0 as int) as is_superuser",
            "cast(floor(c_acctbal) as int) as pending_chat",
            # The first numbers of a fixed list, as many as the key says.
            "if(c_custkey % 29 = 0, null, concat('[', left('0, 1, 2, 3, 4', cast(c_custkey % 6 as int) * 3 - 2), ']'))"
            " as friend_id_list",
            "timestamp'2023-12-25' + make_dt_interval(cast((c_custkey * 7) % 40 as int), cast(c_custkey % 24 as int))"
            " as created_at",
        )

    @cached_property
    def votes(self) -> DataFrame:
        return self._typed("click").select("id", "user_id", "created_at")

    @cached_property
    def blocks(self) -> DataFrame:
        return self._typed("error").select("id", "user_id", "created_at")

    @cached_property
    def payments(self) -> DataFrame:
        products = ", ".join(f"'{p}'" for p in (*CONFIG.prices, "other"))
        return self._typed("purchase").selectExpr(
            "id", "user_id", "created_at", f"get(array({products}), {_K} % 5) as productId")

    @cached_property
    def points(self) -> DataFrame:
        amount = "cast(value as decimal(18,2))"
        return self.events.selectExpr(
            "event_id as id", "user_id", "ts as created_at",
            f"if(event_type in ('error', 'purchase'), -{amount}, {amount}) as delta_point",
            f"if({_K} % 10 = 0, null, event_id) as user_question_record_id")

    @cached_property
    def attendance(self) -> DataFrame:
        """One row per user with a list of distinct days: as many as the calendar has."""
        days = self.events.where("event_type = 'view'").selectExpr(
            "user_id", """concat('"', to_date(ts), '"') as day""").distinct()
        return days.groupBy("user_id").agg(F.collect_list("day").alias("days")).selectExpr(
            "user_id as id", "user_id",
            "concat('[', array_join(sort_array(days), ', '), ']') as attendance_date_list")

    @cached_property
    def broken_users(self) -> DataFrame:
        """Users, some with list text that no parser accepts."""
        return self.users.withColumn("friend_id_list", F.expr("""case
            when friend_id_list is null then null
            when id % 41 = 0 then '[1, 2' when id % 43 = 0 then '[1] [2]' when id % 47 = 0 then '[1,2]xyz'
            else friend_id_list end"""))

    @cached_property
    def broken_attendance(self) -> DataFrame:
        """Attendance, some lists broken and some with a day in a spelling that is not known."""
        return self.attendance.withColumn("attendance_date_list", F.expr("""case
            when user_id % 11 = 0 then '["2024-01-03"'
            when user_id % 7 = 0 then '["2024-01-03", "2024/01/04", "soon"]'
            else attendance_date_list end"""))

    @cached_property
    def hackle_events(self) -> DataFrame:
        return self.events.withColumnRenamed("ts", "event_datetime")

    @cached_property
    def source(self) -> FileSource:
        """The bound tables under their source names; any other name is a test table."""
        return FileSource(self.spark, self.folder, {
            "accounts_user": lambda: self.users,
            "accounts_userquestionrecord": lambda: self.votes,
            "accounts_paymenthistory": lambda: self.payments,
            "accounts_pointhistory": lambda: self.points,
            "accounts_blockrecord": lambda: self.blocks,
            "accounts_attendance": lambda: self.attendance,
            "hackle_events": lambda: self.hackle_events,
        })

    # ---- operators applied to them -------------------------------------------------------

    @cached_property
    def clean(self) -> DataFrame:
        return clean_users(self.users, CONFIG)

    @cached_property
    def days(self) -> DataFrame:
        return attendance_days(self.attendance)

    @cached_property
    def summary(self) -> DataFrame:
        return activity_summary(self.votes, self.payments, self.blocks, self.points, CONFIG.window)

    def profile_of(self, cfg: MartConfig) -> DataFrame:
        return user_profile(self.clean, self.votes, self.payments, self.blocks, self.points, cfg)

    @cached_property
    def profile(self) -> DataFrame:
        return self.profile_of(CONFIG)

    @cached_property
    def general(self) -> DataFrame:
        return general_users(self.profile)

    @cached_property
    def grouped(self) -> DataFrame:
        """The profile with six far-apart groups by key, each with a spread that is small against
        the gaps between them: the groups any fit must find, numbered by the recency of their centres. Real profiles: ``cluster_profiles``."""
        return self.profile.withColumns({
            "friend_cnt": F.expr("cast(10 * (user_id % 6) as int)"),
            "recency": F.expr("cast(40 * (user_id % 6) + (user_id div 6) % 4 as bigint)"),
            "frequency": F.expr("cast(user_id % 2 as bigint)"),
            "monetary": F.expr("cast(100 * (user_id % 6) + (user_id div 24) % 5 * (user_id % 6) as bigint)"),
            "block_cnt": F.expr("cast(if(user_id % 6 = 3, 50, 0) as bigint)")})

    @cached_property
    def broken_props(self) -> DataFrame:
        """Events, some with JSON that is broken, lacks the field, or holds it as something else."""
        return self.events.withColumn("props", F.expr("""case
            when event_id % 41 = 0 then '{"k": 1' when event_id % 43 = 0 then '{"j": 2}'
            when event_id % 47 = 0 then '{"k": null}' when event_id % 53 = 0 then '{"k": "7"}'
            when event_id % 59 = 0 then null when event_id % 61 = 0 then '[1]' else props end"""))

    @cached_property
    def faulty_copy(self) -> DataFrame:
        """The clean users as a replica might hold them: some lost, changed, twice there, or made up."""
        kept = self.clean.where("user_id % 101 <> 0").withColumn("point", F.expr("if(user_id % 103 = 0, point + 1, point)"))
        return kept.unionByName(kept.where("user_id % 107 = 0")).unionByName(
            self.clean.where("user_id % 109 = 0").withColumn("user_id", F.expr("user_id + 1000000000")))

    @cached_property
    def weeks(self) -> DataFrame:
        """One row per user and week over votes, payments and attendance."""
        return user_weeks(CONFIG, votes=self.votes, payments=self.payments, attendance=self.days)

    @cached_property
    def active(self) -> DataFrame:
        return active_user_weeks(self.weeks, self.cluster_map, CONFIG)

    @cached_property
    def cluster_map(self) -> DataFrame:
        return score(self.general, MODEL).select("user_id", "cluster")


EVENTS = TableConfig("events", "ts", "event_id")
USER_POINTS = Contract(
    "user_points", T.StructType([T.StructField("user_id", T.LongType(), False), T.StructField("point", T.LongType())]),
    key=("user_id",))
