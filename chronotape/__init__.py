"""Chronotape: exact, point-in-time market data as PySpark DataFrame operators.

Prices are integer nano-dollars, instants integer nanoseconds, and every operator is a
``DataFrame -> DataFrame`` function that Catalyst plans; nothing here executes rows on the driver.
"""

__version__ = "0.1.0"
