"""regfuse: fuse messy administrative registers with Spark DataFrames.

Sub-packages:

* ``functions`` - Column -> Column normalisers (names, ids, text, amounts, dates)
* ``sources``   - workbook discovery and decoding into a long cells table, sinks
* ``operators`` - header inference, row ids, tiered linkage, consolidation, reports
* ``plans``     - end-to-end jobs and the registered query catalogue
* ``streaming`` - incremental ingestion of workbooks that land in a folder
"""

__version__ = "0.1.0"
