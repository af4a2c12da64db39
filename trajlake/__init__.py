"""trajlake: robot-evaluation log analytics as plain Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` (or ``Column ->
Column``) built from Spark SQL expressions, joins, aggregates and windows.
Time is carried as ``bigint`` microseconds (columns named ``*_us``) so that
sums of periods are exact and independent of the session time zone.
"""

from trajlake.session import get_session

__all__ = ["get_session"]
