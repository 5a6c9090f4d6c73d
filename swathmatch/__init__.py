"""Spark-native matching of satellite scenes with independent observations.

Everything is ``DataFrame -> DataFrame``: clean and canonicalise observation
tables, match them with gridded or sparse scenes in space and time, and report
agreement per source.
"""

from swathmatch.session import build_session, tune

__all__ = ["build_session", "tune"]
