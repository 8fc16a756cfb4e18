"""Training-data operators: fingerprints, deduplication, mixing, joins, extraction,
decontamination, chat formatting, quality and language models, sharding.

Nothing else in the library imports this package.  Its Python code is shipped to the
executors by value, so a cluster needs no copy of the library on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
