"""Operators for preparing training text on Spark.

Each module holds one operator with a general interface; ``queries`` holds the
thin registered queries and their SQL. Nothing else in the library imports
this subpackage.
"""
