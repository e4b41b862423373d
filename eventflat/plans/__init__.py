"""Whole jobs, made of the operators."""

from .events import flatten_events
from .job import run_job
from .sessions import flatten_sessions

__all__ = ["flatten_events", "flatten_sessions", "run_job"]
