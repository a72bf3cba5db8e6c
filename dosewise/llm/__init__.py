"""Training-data pipeline operators (near-duplicates, quality, personal data,
nearest neighbours, packing, URL filters, mixing, toxicity, token counts,
exact top-k, secrets, periodic runs, Merkle manifest). Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the task, so that executors
# need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
