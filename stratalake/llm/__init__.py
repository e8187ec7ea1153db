"""Operators for preparing training data; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# tasks get the functions of this subpackage with the job, so executors need not have it installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
