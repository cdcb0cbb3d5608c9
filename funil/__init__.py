"""Sales-conversation analytics as DataFrame, Spark SQL and Structured Streaming work.

Providers sell price plans, leads contact them over a messaging channel, and an
automated assistant answers.  Every operator takes DataFrames and returns
DataFrames; see ``README.md`` for the map of modules.
"""

from funil.tables import SalesTables

__all__ = ["SalesTables"]
