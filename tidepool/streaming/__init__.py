"""Streaming entry points.

The reference works on dated snapshots only (no watermarks, windows or
state), so streaming here means restartable, bounded micro-batch ingestion of
a large snapshot with the batch text operators (see ``ingest``).
"""
