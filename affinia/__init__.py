"""Affinia: item catalogues, similarity and search as Spark DataFrame jobs.

Sub-packages

* ``sources``   delimited and parquet readers, sinks, tables, the shared work area
* ``functions`` column expressions: predicates, token and vector expressions
* ``operators`` DataFrame jobs: profiles, features, pairs, neighbours, search, ...
* ``plans``     end-to-end jobs, and the registered queries over the test tables
"""

__version__ = "0.1.0"
