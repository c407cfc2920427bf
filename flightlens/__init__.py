"""Spark-native analytics over aircraft position reports.

Everything public is a plain ``DataFrame -> DataFrame`` function, usable with
``df.transform(...)``.  Start with :mod:`flightlens.plans`.
"""

__version__ = "0.1.0"
