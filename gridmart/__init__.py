"""gridmart: raw operational feeds to a dimensional model, on PySpark.

Everything is a plain function from DataFrame to DataFrame; Catalyst picks the
physical plan. See README.md for the map of the package.
"""
