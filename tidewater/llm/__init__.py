"""Operators of a training-data pipeline, each built on Spark jobs.

Nothing else in the library imports this subpackage.  ``queries.py`` registers
one query per operator, ``oracle.py`` holds the SQL for those SQL can express.
"""
