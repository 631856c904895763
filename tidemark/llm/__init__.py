"""Operators of a training-data pipeline: near-duplicates, line de-duplication, scoring, redaction, tokens.

Functions that run inside tasks travel with the job, so executors need not
have this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
