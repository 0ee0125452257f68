"""Operators of a training-data pipeline: dedup, cleaning, sharding, tokens, archives, packing.

Every operator takes a DataFrame and the names of the columns it reads, reads no other
column, and returns its own columns; so extra columns of the input can never clash.
"""

import sys

from pyspark.cloudpickle import cloudpickle

# Task functions of this package travel with the job, so workers need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
