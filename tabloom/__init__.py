"""Tabular synthesis and evaluation on Spark DataFrames.

Every operator follows one shape: ``*_fit(df, ...)`` is an action that returns
a small spec of plain values, ``*_transform(df, spec)`` and ``*_back(df, spec)``
are projections built from that spec.
"""

import sys

from pyspark import cloudpickle

# task functions travel with the job, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
