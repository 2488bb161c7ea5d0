"""Small tables from text literals, and results as plain values."""

from datetime import date, datetime

from pyspark.sql import functions as F


def literal(value):
    if value is None:
        return "null"
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, date):
        return f"date'{value}'"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def table(spark, columns, *rows):
    """Rows of Python values as an inline table; a ``timestamp`` column takes text, read as UTC."""
    kinds = dict(c.split(":") for c in columns.split())
    body = ", ".join(f"({', '.join(map(literal, r))})" for r in rows)
    if not rows:
        body = f"({', '.join(['null'] * len(kinds))})"
    casts = ", ".join(f"cast({n} as {k}) as {n}" for n, k in kinds.items())
    df = spark.sql(f"select {casts} from values {body} as t({', '.join(kinds)})")
    return df if rows else df.limit(0)


def values(df, *columns):
    """Sorted rows as tuples; timestamps as text, so that the host's zone is out of play."""
    columns = columns or df.columns
    kinds = dict(df.dtypes)
    shown = [F.col(c).cast("string").alias(c) if kinds[c] == "timestamp" else F.col(c) for c in columns]
    return sorted((tuple(r) for r in df.select(*shown).collect()), key=str)


def one(df, column):
    rows = df.select(column).collect()
    assert len(rows) == 1
    return rows[0][0]


USER = ("id:bigint gender:string group_id:int point:bigint is_staff:int is_superuser:int pending_chat:int"
        " friend_id_list:string created_at:timestamp")
EVENT = "id:bigint user_id:bigint created_at:timestamp"
PAYMENT = EVENT + " productId:string"
POINT = EVENT + " delta_point:bigint user_question_record_id:bigint"
ATTENDANCE = "id:bigint user_id:bigint attendance_date_list:string"


def user(id, **changes):
    row = dict(id=id, gender="M", group_id=1, point=10, is_staff=0, is_superuser=0, pending_chat=0,
               friend_id_list="[1]", created_at="2023-01-01")
    return tuple((row | changes).values())


def users(spark, *rows):
    return table(spark, USER, *rows)


def events(spark, *pairs):
    """Events as (user, time) pairs."""
    return table(spark, EVENT, *((i, u, t) for i, (u, t) in enumerate(pairs)))


def payments(spark, *triples):
    return table(spark, PAYMENT, *((i, u, t, p) for i, (u, t, p) in enumerate(triples)))


def points(spark, *triples):
    return table(spark, POINT, *((i, u, t, d, i) for i, (u, t, d) in enumerate(triples)))


def at(text):
    return datetime.fromisoformat(text)
