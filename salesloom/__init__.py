"""salesloom: a retail star-schema warehouse on Apache Spark.

Layers:

* ``sources``   -- seed CSV readers, the transaction text parser, and the
                   mapping of the provided TPC-H-like tables onto the star.
* ``functions`` -- scalar Column helpers (calendar buckets, exact decimal
                   rounding, period-over-period labels).
* ``operators`` -- DataFrame -> DataFrame building blocks (dimension builds,
                   enrichment with quarantine, additive fact collapse,
                   checked dimension joins, prior-period, product pairs,
                   data-quality checks).
* ``plans``     -- the star container, the warehouse build, and the
                   analytic query catalogue.
* ``streaming`` -- the Structured Streaming loader for the fact table.
"""

__version__ = "0.1.0"
