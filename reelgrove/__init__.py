"""Content recommendation and viewing analytics as Spark jobs."""

from reelgrove.session import build_session, shared_dir, stored, tune

__all__ = ["build_session", "shared_dir", "stored", "tune"]
