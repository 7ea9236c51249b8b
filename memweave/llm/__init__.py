"""Operators of a training-data pipeline over large text tables.

One module per operator. Every public function takes and returns DataFrames;
Spark partitions and shuffles the work, NumPy works on whole Arrow batches
inside a task. Nothing else in the library imports this subpackage.
"""
