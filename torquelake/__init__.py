"""Vehicle-telemetry analytics on Spark: enrich, flag and summarise sensor events, in batch and in streams."""

from torquelake.config import AlertRules, Settings, configure, prepare_session, scratch_folder

__all__ = ["AlertRules", "Settings", "configure", "prepare_session", "scratch_folder"]
