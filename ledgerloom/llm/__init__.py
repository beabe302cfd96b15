"""Operators for preparing training data: packing, filters, counts, joins, classifiers, search and mixing."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
