"""Every named query against its SQL, on whole test tables."""

import glob
import math
import os

import pytest

from cohortmill import catalog
from cohortmill.catalog.bindings import CONFIG, Bound
from cohortmill.operators import clusters
from cohortmill.operators.clusters import cluster_users

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
ORACLE = catalog.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return None if value is None else str(value)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, tables, name):
    df = catalog.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(*columns).collect()), key=str)
    result = tables.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = sorted((tuple(plain(r[i]) for i in order) for r in result.fetchall()), key=str)
    assert got == want


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(ORACLE)


def test_fitted_clusters_cover_every_ordinary_user(spark, tables):
    labelled = cluster_users(Bound(spark, FOLDER).general, CONFIG)[0].collect()
    assert {r.cluster for r in labelled} <= set(range(6))
    ids = [r.user_id for r in labelled]
    people = {r[0] for r in tables.execute(ORACLE["general_users"]).fetchall()}
    assert len(ids) == len(set(ids)) and set(ids) == people


def test_the_fit_of_real_profiles_has_many_combinations(spark, monkeypatch):
    seen = []
    fit = clusters.fit_clusters
    monkeypatch.setattr(clusters, "fit_clusters", lambda general, *rest: seen.append(general) or fit(general, *rest))
    assert catalog.QUERIES["cluster_profiles"](spark, FOLDER).count() > 0
    assert clusters.combinations(seen[0]).count() > CONFIG.k
