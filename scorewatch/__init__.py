"""scorewatch: payments risk analytics on PySpark.

Change-data events, card feeds and daily CSV drops become fraud alerts and a
full credit-score history. Every transform is a ``DataFrame -> DataFrame``
function built from stock Spark SQL operators; jobs in ``plans.pipeline`` and
``streaming`` add the I/O.
"""

from scorewatch.session import configure, local_session

__all__ = ["configure", "local_session"]
