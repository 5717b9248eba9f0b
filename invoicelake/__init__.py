"""Retail invoice analytics on Spark: bronze, silver, gold, churn and the checks around them.

Every operator takes DataFrames and returns DataFrames; reading and publishing live in
``sources`` and ``plans``.
"""
