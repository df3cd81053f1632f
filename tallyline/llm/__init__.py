"""Operators and the corpus pipeline for large-scale training data.

Nothing outside this subpackage imports it. Each module holds one operator
with a general interface; ``registry`` holds the thin ``opN_<name>`` queries.
"""

import sys

from pyspark import cloudpickle

# Python workers need not have this package on their path: functions sent to
# them carry their code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
