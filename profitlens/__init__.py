"""profitlens: retail gross-margin analytics as plain Spark DataFrame functions.

Layout
------
functions/  column expressions (ratio, code conformance, money, regex filters)
operators/  DataFrame operators (rollup, fact combine, masters, allocation, statistics)
sources/    readers/writers and the binding of the driver's test tables to the facts
plans/      end-to-end reports composed from the operators
streaming/  incremental ingestion of period extracts with Structured Streaming
"""

__version__ = "0.1.0"
