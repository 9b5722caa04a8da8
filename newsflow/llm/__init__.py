"""Operators for training-data pipelines. Nothing else in the library imports this subpackage.

Every operator takes a frame of documents and reads only the columns it names (``doc_id`` and
``text`` unless it says otherwise); other columns, also such with the names of its own outputs, are
left alone. Rows that repeat a ``doc_id`` are one document wherever an operator speaks of documents.
"""

from pyspark import cloudpickle

import newsflow

# tasks get the functions with the job, so the package need not be installed on the executors
cloudpickle.register_pickle_by_value(newsflow)
