"""Operators for preparing language-model training text.

Functions of this package travel to the workers by value, so a cluster needs
no copy of the package on its machines.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
