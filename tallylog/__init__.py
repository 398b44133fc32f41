"""tallylog: access-log analytics on Spark DataFrames.

Raw Common Log Format lines are read with ``spark.read.text``, numbered and
batched, parsed with built-in column expressions, and reduced to three
reports (daily traffic, top resources, hourly errors) plus run statistics.
"""

__version__ = "0.1.0"
