"""marquee -- a Spark medallion engine for a movie catalogue.

Layers and where they live:

* ``marquee.functions``  -- Column -> Column cleaning functions (text, numbers, dates).
* ``marquee.operators``  -- DataFrame -> DataFrame: dedupe, the seven cleaners, the marts.
* ``marquee.sources``    -- schemas, feed readers (JSON/CSV/XML/Parquet/JDBC), sinks
  (feed writers, the layer ``Store``, audit log, JDBC writer).
* ``marquee.plans``      -- dataset registry, pipeline steps and ``run_pipeline``, the
  fixtures derived from the driver tables, registered queries and their oracles.
* ``marquee.session``    -- ``get_spark`` and the shared-folder helpers.

Command line: ``python -m marquee run --landing <feeds> --lake <tables>``.
"""

__version__ = "0.1.0"
