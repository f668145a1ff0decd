"""tidemark: daily dated-stream processing on Spark DataFrames.

A processor reads the dated topics (or dated folders) of its upstream
producers, applies a DataFrame -> DataFrame algorithm to each micro-batch,
writes every batch under ``{date}/{bb}00``, records it in a ledger, and rolls
to the next date once its upstreams have finished the current one.

Sub-packages:

* ``functions``  -- column expressions (fingerprints, partitions, commit points, dates, outcomes)
* ``operators``  -- DataFrame operators (batches, replay, metadata, as-of join, metrics, enrich)
* ``sources``    -- readers (dated topics, committed batches, counter files)
* ``sinks``      -- writers (messages, batch text, routed output, ledger)
* ``streaming``  -- Structured Streaming runner, day loop, progress log, stateful replay
* ``plans``      -- the registered queries over the driver tables and their SQL oracles
"""

__version__ = "0.1.0"
