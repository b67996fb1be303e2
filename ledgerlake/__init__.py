"""ledgerlake: Spark-native lakehouse processing for banking records.

Subpackages: ``sources`` (typed readers), ``operators`` (cleaning, dedupe,
sequencing, quality rules, star queries), ``functions`` (column helpers),
``sinks`` (writers), ``streaming`` (running totals, ledger, windows),
``plans`` (ETL job, registered queries).
"""

__version__ = "0.1.0"
