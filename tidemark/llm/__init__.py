"""Operators for training-data pipelines, each over whole tables of documents.

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds
its queries when it is present. Functions of this subpackage travel to the Python
workers with the tasks that use them, so executors need not have it installed.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
