"""Scans and sinks (``io``)."""
