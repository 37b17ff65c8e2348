"""Training-data operators: ten corpus operators plus the queries that apply them to whole tables.

Nothing else in the library imports this subpackage.  ``queries`` and
``oracle_sql`` give the registrations that the repository's entry module adds.
"""
