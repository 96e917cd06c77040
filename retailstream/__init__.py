"""retailstream — real-time retail warehouse jobs on PySpark.

Every operator is a plain ``DataFrame -> DataFrame`` function built from the
DataFrame / SQL API, usable on batch tables and (where marked) on streams.
Sub-packages:

* ``sources``   — topic / table readers, sinks, and adapters from the test tables
* ``functions`` — column-level helpers (time, metrics, tokenizer)
* ``operators`` — log cleaning, CDC, visits, orders, dimensions, stats, reports
* ``streaming`` — Structured Streaming jobs and stateful processors
* ``plans``     — the registered end-to-end queries and their SQL oracles
"""

__version__ = "0.1.0"
