"""Messages to trusted tables on Spark: intake, extraction, upsert, reconciliation, profiling."""

import sys

from pyspark import cloudpickle

# Ship the few Python functions with the plan, so that executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
