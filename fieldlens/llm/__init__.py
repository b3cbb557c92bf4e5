"""Training-data operators: filtering, deduplication, decontamination,
mixing, sharding and scanning of document tables.

Nothing else in the library imports this subpackage.  Every operator takes a
DataFrame and the names of its key and text columns, reads only those, and
returns its own columns, so extra input columns (whatever their names) never
clash with an operator's working columns.

Functions that run on executors travel with the job, so workers need no copy
of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
