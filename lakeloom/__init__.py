"""Lakehouse operators for PySpark: raw -> bronze -> silver -> gold over plain DataFrames.

Sub-packages:

* ``functions``  column expressions: tolerant casts, hash keys, JSON parsing
* ``sources``    readers, writers, physical layout, staging of intermediate tables
* ``operators``  DataFrame -> DataFrame operators: cleansing, dimensions, loads, snapshots
* ``plans``      whole plans built from the operators, and the registered queries
* ``streaming``  intentionally empty, see its docstring
"""
