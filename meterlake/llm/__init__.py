"""Operators for large-scale training-data preparation, one module each.

Nothing else in the library imports this subpackage. Every operator takes
DataFrames and returns DataFrames, reads only the columns it is told to
(others are ignored, whatever their names) and states in its docstring what
null, empty and repeated rows give.
"""
