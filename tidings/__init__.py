"""tidings: story analytics over news feeds, written as Spark DataFrame jobs."""

from tidings.session import build_session, configure, materialize, scratch, work_dir

__all__ = ["build_session", "configure", "materialize", "scratch", "work_dir"]
