"""Table-in, table-out analytics on PySpark: sources, operators, streams and whole jobs."""

from tidewright.session import build_session, fresh_path, prepare, settle

__all__ = ["build_session", "fresh_path", "prepare", "settle"]
