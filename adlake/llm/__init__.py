"""Training-data pipeline operators (numbered 1 to 10) and their registered queries.

Nothing else in the library imports this subpackage. ``queries.QUERIES`` and
``queries.ORACLE`` are added to the registry by ``__spark_entry__``.
"""
