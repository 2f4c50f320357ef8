"""What a failing Spark job or source can raise on the driver."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

SPARK_ERRORS = (PySparkException, Py4JJavaError)


def message(error: Exception) -> str:
    """The whole message of an error, without the Java stack: what is stored."""
    if isinstance(error, Py4JJavaError):
        cause = error.java_exception
        while cause.getCause() is not None:
            cause = cause.getCause()
        return str(cause.toString()).strip()
    return str(error).strip()


def first_line(error: Exception) -> str:
    """The first line of an error, for the log."""
    return message(error).split("\n", 1)[0]
