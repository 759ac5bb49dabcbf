"""cardlake: card-transaction analytics as Spark DataFrame jobs.

Layers (each a set of DataFrames, persisted as Parquet):

    raw  ->  transformation (cleaned)  ->  curated (star schema)  ->  marts

`cardlake.plans` holds the jobs, `cardlake.functions` the column expressions
they are built from, `cardlake.operators` reusable table operators (keep-first,
dense keys, sized broadcast, quality checks, sinks), `cardlake.sources` the
inputs and the layer store, `cardlake.streaming` the incremental load.
"""

__version__ = "0.1.0"
