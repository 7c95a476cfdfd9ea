"""tripwire: plant decoy rows in large tables and detect who reads them, on Spark.

Every operator is a DataFrame -> DataFrame transformation (Spark SQL, Spark ML or
Structured Streaming). Sub-packages:

* ``sources``   – table readers, the ledger/access-log views, writers (sinks)
* ``functions`` – column-expression builders (row hashing, seeded draws, features)
* ``operators`` – preparation, ranking/sampling, lookup, injection, detection,
                  metrics, quality, synthesis, models
* ``plans``     – registered queries and their SQL oracles, end-to-end pipeline
* ``streaming`` – Structured Streaming forms of the detection operators
"""

__version__ = "0.1.0"
