"""The jobs: read, transform, write."""

from .load import LoadResult, load_table, load_warehouse
from .mart import append_new, run_activity_mart, update_clusters, update_super_users, update_timeseries
from .publish import publish
from .replica import sync_replica

__all__ = [
    "LoadResult", "append_new", "load_table", "load_warehouse", "publish", "run_activity_mart", "sync_replica",
    "update_clusters", "update_super_users", "update_timeseries",
]
