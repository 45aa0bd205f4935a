"""Instalment-portfolio analytics as PySpark DataFrame functions.

Every operator maps DataFrames (plus an explicit as-of date where time matters)
to a DataFrame.  Nothing here reads the wall clock, collects data to the driver
or relies on the size of one key's group.
"""

from arrearium.rules import PortfolioRules
from arrearium.session import get_session

__all__ = ["PortfolioRules", "get_session"]
