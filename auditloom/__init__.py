"""Invoice audit as Spark jobs: extraction, duplicate, statistics and report tables."""

import sys

from pyspark import cloudpickle

from auditloom.params import AuditParams

# functions that run in Python workers travel with the job, so that executors
# need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["AuditParams"]
