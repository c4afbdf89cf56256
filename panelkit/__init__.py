"""panelkit: firm-panel analytics on Spark.

Builds firm-month panels from listing, delisting and financial-statement tables,
labels delisting events, aggregates firm-year features, splits firms chronologically
and fits a class-balanced logistic regression -- all as DataFrame plans.
"""

__version__ = "0.1.0"
