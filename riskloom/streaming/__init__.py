"""Structured Streaming front-end for the drift operator (the only operator of the
engine that is naturally continuous: comparing newly arriving applications with a
fixed reference).  See :mod:`.drift_monitor`."""

from .drift_monitor import start_drift_monitor  # noqa: F401
