"""Reporting, stock, receivables and table-maintenance operators on PySpark.

Everything is ``DataFrame -> DataFrame`` (or ``Column -> Column``); nothing keeps
global state and every as-of date is an argument.
"""
