"""Training-data operators: filters, deduplication, joins, tokenising, packing.

Nothing else in the library imports this subpackage; ``queries.py`` holds
the registered ``opN_<name>`` queries and their SQL.
"""
