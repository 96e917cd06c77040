"""Operators of a training-data pipeline: filters, deduplication, mixing, packing.

Each module holds one operator with its own general interface; ``queries``
registers one query per operator over the supplied tables.  Nothing else in the
package imports this one.
"""
