"""Invoice-anomaly analytics on Spark DataFrames.

Layers: ``sources`` (files and the star-schema adapter), ``functions`` (column
expressions), ``operators`` (DataFrame in, DataFrame out) and ``plans`` (jobs that
chain operators).
"""

import sys

from pyspark import cloudpickle

# Functions that run inside Python workers travel with the job, so executors need
# no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
