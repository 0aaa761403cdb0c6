"""orderweir: a sales lakehouse on Spark DataFrames and Structured Streaming."""

from orderweir.session import build_session, configure, shared_dir

__all__ = ["build_session", "configure", "shared_dir"]
