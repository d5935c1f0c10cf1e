"""Training-data operators: licence scans, mixing, sharding, deduplication,
HTML extraction, decontamination, URL and quality filters, conversation tries,
fill-in-middle texts and language identification.

Nothing else in the library imports this subpackage.  ``queries.py`` holds the
registered queries, the other modules one operator each.
"""

import sys

from pyspark import cloudpickle

# Ship the operators' task functions with each job: executors then need not have
# the package installed, nor share a working directory with the driver.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
