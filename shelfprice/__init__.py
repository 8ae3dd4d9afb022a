"""shelfprice: weekly price, cost and competitor analytics on Spark DataFrames.

Every public function takes DataFrames (and column names / parameters) and
returns DataFrames built from built-in Spark expressions; nothing is collected
to the driver in the core path.
"""

__version__ = "0.1.0"
