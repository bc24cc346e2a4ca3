"""Incremental loads: look-back windows, backfills and partition refresh.

The feeds are bounded tables partitioned by day. A run reads the last days again and replaces
exactly the partitions it touched, so late rows are absorbed by the next run.
"""
