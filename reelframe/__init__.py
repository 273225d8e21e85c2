"""Spark jobs and DataFrame operators for a wide, string-typed film catalogue."""

from reelframe.session import build_session, scratch_path, scratch_scope, scratch_table, sized_for

__all__ = ["build_session", "scratch_path", "scratch_scope", "scratch_table", "sized_for"]
