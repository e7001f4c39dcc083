"""tallyspark: business analytics over Spark DataFrames.

Six families of analytics (loyalty, orders, subscriptions, balances, weekly
retail, clickstream) written as functions from DataFrames to a DataFrame.
Every function is a lazy Catalyst plan: no collect, no Python UDF.
"""

__version__ = "0.1.0"
