"""Training-data operators: filters, deduplication, decontamination, packing.

Nothing outside this package imports it. Every operator takes plain frames and
column names; ``queries`` holds the registered queries.
"""
