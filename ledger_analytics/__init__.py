"""Spark-native analytics for regulated-entity accounting statements.

Every public transformation takes DataFrames and returns a DataFrame built
from Catalyst expressions; sources and sinks live in their own modules.
"""

__version__ = "0.1.0"
