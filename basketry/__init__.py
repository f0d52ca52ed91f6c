"""Two-stage product recommendation as Spark jobs.

Every operator is a function from DataFrame to DataFrame.  ``sources`` reads and
publishes tables, ``operators`` holds the work itself, ``functions`` the column and
grouping helpers they share, ``plans`` the composed stages and the registered queries,
``jobs`` the spark-submit entry points.
"""

__version__ = "0.1.0"
