"""Operators of a training-data pipeline: sketches, de-duplication, decontamination, scans, counts, mixing.

Each module holds one operator; ``queries`` registers them over the ``documents`` tables.
Nothing else in the library imports this subpackage.
"""
