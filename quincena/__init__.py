"""Spark-native engine for payroll data published as repeated full snapshots.

Every operator is a plain ``DataFrame -> DataFrame`` function; the streaming
wrappers in :mod:`quincena.streaming` call the same functions inside
``foreachBatch`` so batch and stream give the same answer.
"""

__version__ = "0.1.0"
