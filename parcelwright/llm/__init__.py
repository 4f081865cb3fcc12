"""Operators that prepare text for training language models.

Functions that run in Python workers are sent with the job, so executors need no copy of this
package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
