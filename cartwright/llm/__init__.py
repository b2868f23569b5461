"""Preparation of training text: decontamination, sharding, quality, deduplication, tokens, licences, URLs.

The functions that run inside tasks travel with the job, so workers do not need the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
