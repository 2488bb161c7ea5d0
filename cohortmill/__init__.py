"""Warehouse loads and user-activity marts as Spark jobs."""

from .config import STAGES, TABLES, AnalysisWindow, MartConfig, TableConfig, Tier
from .plans import load_table, load_warehouse, publish, run_activity_mart, sync_replica
from .session import build_session, ensure_session
from .sources import FileSource, JdbcSink, JdbcSource, TableStore

__all__ = [
    "STAGES", "TABLES", "AnalysisWindow", "FileSource", "JdbcSink", "JdbcSource", "MartConfig", "TableConfig", "TableStore",
    "Tier", "build_session", "ensure_session", "load_table", "load_warehouse", "publish", "run_activity_mart", "sync_replica",
]
