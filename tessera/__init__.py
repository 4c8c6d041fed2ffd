"""tessera: table-in, table-out analytics operators on Spark DataFrames.

Every operator is a plain function ``op(df, ...) -> DataFrame``: lazy, no
``collect`` of data-sized results, heavy work in Spark joins, windows and
aggregations.  Sub-packages:

* ``sources``   readers, writers and the test-data views
* ``functions`` Column-level helpers (tokenizers, distances, fixed word lists)
* ``operators`` relational, text, summaries, graph, clustering, reduction,
                supervised learning and time series operators
* ``plans``     named queries built from operators, with DuckDB oracles
* ``streaming`` Structured Streaming counterpart of the event counts
"""

from tessera.session import get_spark, checkpoint_dir, cut_lineage  # noqa: F401

__version__ = "0.1.0"
