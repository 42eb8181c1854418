"""Training-data operators: mixing, language, quality, decontamination, copies, licences, shards, personal data.

Functions that run inside tasks are sent to the executors by value, so the executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
