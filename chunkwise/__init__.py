"""chunkwise: record validation, chunked scoring and job/task ledgers on Spark.

Every public operator takes and returns a ``DataFrame`` (or a ``Column``) and
is expressed with the DataFrame / SQL API so Catalyst can prune, push down and
plan it.  Sub-packages:

* ``functions``  Column -> Column helpers (normalisation, rounding, rules)
* ``sources``    scans and sinks (Parquet, JSON, versioned tables, events)
* ``operators``  DataFrame -> DataFrame operators (validation, chunking,
                 features, model, ledger)
* ``streaming``  Structured Streaming jobs built from the same operators
* ``plans``      end-to-end jobs and the bindings used by the driver
"""

__version__ = "0.1.0"
