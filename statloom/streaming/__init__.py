"""Incremental runs of batch plans with file-source streams; there is no continuous state to keep."""
