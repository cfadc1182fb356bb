"""Operators of a training-data pipeline over the corpus tables.

Each module holds one operator as functions of DataFrames; ``queries``
applies every operator to its whole table.  Nothing outside this subpackage
imports it.
"""
