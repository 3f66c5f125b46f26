"""Counts taken while a frame is written."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation


def metrics(seen: Observation, **empty) -> dict:
    """What ``seen`` counted in an action that has ended; ``empty`` if its input was found to be empty while planning.

    Spark then drops the metrics from the plan with their input, and asking for them fails an assertion.
    """
    try:
        return seen.get
    except Py4JJavaError as e:
        if e.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return empty
