"""Operators of a training-data pipeline over documents and pages.

What holds for all of them: a null text counts as an empty one; rows are told
apart by their id (null last) and a hash of their text, so repeated rows get
equal results; an empty table gives an empty result; input columns may have any
names, and those that an operator adds replace columns of the same name.
Intermediate tables are written in the shared folder ``spark.checkpoint.dir``.
"""
