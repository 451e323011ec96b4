"""Metrics counted while rows are written."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.sql import Observation


def observed(found: Observation, otherwise: Callable[[], dict]) -> dict:
    """The metrics of a finished query; those of ``otherwise`` where the planner has dropped them.

    Where a shuffle turns out to move no row, the adaptive planner replaces all that led to it, and with it the node that
    counted, whatever it has seen.
    """
    try:
        return found.get
    except Py4JError:
        return otherwise()
