"""Only what is asked of a database is checked here; none is started."""

from datetime import datetime

from cohortmill import TABLES, JdbcSource
from cohortmill.sources.jdbc import KeyRange, even_edges, key_range, slices_of, time_slices


def test_plain_options():
    source = JdbcSource(None, "jdbc:mysql://host/raw", {"user": "u"})
    got = source.options(TABLES["hackle_events"])
    assert got["dbtable"] == "hackle_events" and got["fetchsize"] == "5000" and got["user"] == "u"
    assert "partitionColumn" not in got
    assert got["useCursorFetch"] == "true"
    assert "useCursorFetch" not in JdbcSource(None, "jdbc:postgresql://host/raw").options(TABLES["hackle_events"])


def test_key_range_makes_the_read_parallel():
    source = JdbcSource(None, "jdbc:mysql://host/raw", ranges={"accounts_user": KeyRange(1, 700_000, 64)})
    got = source.options(TABLES["accounts_user"])
    assert (got["partitionColumn"], got["lowerBound"], got["upperBound"], got["numPartitions"]) == (
        "id", "1", "700000", "64")


def test_time_slices_cover_every_row_once(spark):
    edges = even_edges(datetime(2024, 1, 1), datetime(2024, 1, 5), 4)
    slices = time_slices("t", edges)
    assert len(edges) == 3 and len(slices) == 4
    df = spark.sql("select * from values (null), ('2023-01-01'), ('2024-01-02'), ('2024-01-03 12:00'), ('2024-01-04'),"
                   " ('2025-01-01') as x(s)").selectExpr("cast(s as timestamp) as t")
    assert [df.where(s).count() for s in slices] == [2, 1, 1, 2]
    assert time_slices("t", []) == ["1 = 1"]


def test_bounds_are_those_of_the_rows_to_read(spark):
    source = JdbcSource(None, "jdbc:mysql://host/raw", partitions=16)
    cfg = TABLES["accounts_userquestionrecord"]
    assert source.bounds_query(cfg, None) == f"SELECT MIN(id) AS low, MAX(id) AS high FROM {cfg.name}"
    assert source.bounds_query(cfg, datetime(2024, 1, 15)).endswith(
        f"FROM {cfg.name} WHERE {cfg.incremental_col} > '2024-01-15 00:00:00.000000'")
    span = key_range(spark.sql("select 901L as low, cast(1600 as decimal(20,0)) as high"), source.partitions)
    assert span == KeyRange(901, 1601, 16)
    got = source.options(cfg, span)
    assert (got["lowerBound"], got["upperBound"], got["numPartitions"]) == ("901", "1601", "16")


def test_no_range_for_no_rows_or_text_keys(spark):
    assert key_range(spark.sql("select cast(null as int) as low, cast(null as int) as high"), 4) is None
    assert key_range(spark.sql("select 'a' as low, 'b' as high"), 4) is None


def covered(df, slices):
    counts = [df.where(s).count() for s in slices]
    assert sum(counts) == df.count()
    return counts


def test_quantile_slices_of_skewed_keys_cover_every_row_once(spark):
    cfg = TABLES["accounts_userquestionrecord"]
    source = JdbcSource(None, "jdbc:mysql://host/raw", partitions=8)
    # Most keys lie close together, some far out, some rows have none.
    df = spark.sql(f"""select if(id % 50 = 0, null, if(id < 900, id, id * id * 1000)) as {cfg.pk},
        timestamp'2024-01-01' + make_dt_interval(cast(id div 10 as int)) as {cfg.incremental_col} from range(1000)""")
    df.createOrReplaceTempView(cfg.name)
    slices = slices_of(cfg.pk, spark.sql(source.quantile_query(cfg, cfg.pk, None)), 8, source.hash_sql)
    counts = covered(df, slices)
    assert len(counts) == 8 and max(counts) <= 1.2 * 1000 / 8
    # Of an increment, only the rows to read are spread; all others are in the first slice.
    after = datetime(2024, 3, 1)
    slices = slices_of(cfg.pk, spark.sql(source.quantile_query(cfg, cfg.pk, after)), 8, source.hash_sql)
    covered(df, slices)
    fresh = df.where(f"{cfg.incremental_col} > '{after}' and {cfg.pk} is not null")
    counts = [fresh.where(s).count() for s in slices]
    assert max(counts) - min(counts) <= 1


def test_tables_without_a_key_are_sliced_by_time(spark):
    cfg = TABLES["hackle_events"]
    source = JdbcSource(None, "jdbc:mysql://host/raw", partitions=5)
    # A third of all rows at one time: they stay together and cost an edge.
    df = spark.sql(f"""select case when id % 3 = 0 then timestamp_ntz'2024-05-01 10:00:00.25' when id % 20 = 1 then null
        else timestamp_ntz'2024-01-01' + make_dt_interval(cast(id as int)) end as {cfg.incremental_col} from range(300)""")
    df.createOrReplaceTempView(cfg.name)
    edges = spark.sql(source.quantile_query(cfg, cfg.incremental_col, None))
    slices = slices_of(cfg.incremental_col, edges, 5, source.hash_sql)
    assert 3 <= len(slices) <= 5 and max(covered(df, slices)) < 200
    assert slices_of("t", edges.limit(0), 5, source.hash_sql) == ["1 = 1"]


def test_text_keys_are_dealt_by_hash(spark):
    source = JdbcSource(None, "jdbc:mysql://host/raw", partitions=4)
    df = spark.sql("""select if(id % 40 = 0, null, concat(chr(39), 'k', id)) as k from range(400)""")
    slices = slices_of("k", df.selectExpr("k as edge"), 4, source.hash_sql)
    counts = covered(df, slices)
    assert len(counts) == 4 and min(counts) > 60
