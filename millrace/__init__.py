"""Table and message-feed jobs written with the Spark DataFrame API."""

from millrace.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
