"""Distributed analytics for environmental sensor time series on PySpark.

Readings of any number of sites and devices are one DataFrame keyed by
``(temple_id, device_id, time)``; every operator works on all devices at once
and returns a lazy DataFrame.
"""

from sensorloom.session import configure, get_session

__all__ = ["configure", "get_session"]
