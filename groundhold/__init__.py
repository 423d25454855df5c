"""groundhold: flight-delay economics on Spark.

Every public function takes DataFrames and returns a lazy DataFrame (or takes
Columns and returns a Column); no flight data is collected on the driver.

* ``groundhold.sources``    readers, sinks and seed tables
* ``groundhold.functions``  column functions
* ``groundhold.operators``  staging, roll-ups, windows, cascade joins, checks
* ``groundhold.plans``      marts, portfolio questions and serving queries
* ``groundhold.streaming``  Structured Streaming feeds
"""

__version__ = "0.1.0"
