"""Tidemark: social-content lakehouse analytics as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code along, so workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
