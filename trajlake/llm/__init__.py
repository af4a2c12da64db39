"""Operators of a training-data pipeline over tables of documents and vectors.

Each module holds one operator with a general DataFrame interface;
``queries`` holds the registered ``opN_`` queries, which derive digest columns
from what the operators return. Nothing outside this package imports it.
"""
