"""Training-data operators (deduplication, decontamination, classifiers, tokenizing, search).

Every operator takes DataFrames and returns a DataFrame. Tables are named by the
columns they must have (``doc_id`` long, ``text`` string; see each operator);
other columns are ignored, whatever their names. Task functions are sent to the
executors by value, so the workers need not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
