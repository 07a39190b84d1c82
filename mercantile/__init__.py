"""Retail analytics and table maintenance on Spark DataFrames.

Every operator takes DataFrames and returns DataFrames (or a small named tuple
of them); nothing is collected to the driver except one-row flags and loop
frontiers' emptiness checks.
"""

__version__ = "0.1.0"
