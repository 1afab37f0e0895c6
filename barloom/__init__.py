"""barloom: daily market bars (open, high, low, close, volume) analysed on Spark.

Every operator is a function from DataFrame to DataFrame, usable with
``DataFrame.transform``, and works on all series at once.
"""

__version__ = "0.1.0"
