"""strata: layered (raw -> star schema -> reporting) batch analytics on Spark.

Every operator is a plain function from DataFrames to a DataFrame, built on the
public DataFrame / SQL API so Catalyst can prune, push down and re-plan the
whole chain. Sub-packages:

- ``sources``   positional CSV ingest, table and SQL read-back, test-table stand-ins
- ``functions`` column expressions: renames, audit column, null markers, flags
- ``operators`` joins, roll-ups, rankings, streaks, last-round snapshots
- ``sinks``     schema contracts, idempotent (partitioned) overwrites, layer DDL
- ``plans``     table contracts, the 20-table pipeline, dashboard views
- ``llm``       training-data operators (nothing else imports it)
"""

__version__ = "0.1.0"
