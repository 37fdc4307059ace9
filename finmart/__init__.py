"""finmart: a PySpark-native financial warehouse and decision-support library.

Raw statements and price bars go in; cleaned Silver tables, a star schema,
wide marts, EDA summaries, return models, forecasts and scenario bands come
out. Every function takes and returns DataFrames, so steps compose with
``df.transform(fn)`` and Catalyst sees one plan end to end.
"""

__version__ = "0.1.0"
