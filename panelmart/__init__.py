"""panelmart: yearly valuation panels on Spark.

Subpackages:

* ``functions``  – Column helpers (labels, buckets, change columns, text, keys, predicates)
* ``operators``  – DataFrame operators (joins, aggregates, exact percentiles, windows,
                   reshape, sets, schema conformance, data-quality checks)
* ``plans``      – composite analytics (YoY panel, value change, driver bridge, waterfalls,
                   cumulative index, validation funnel, override family)
* ``sources``    – tables and marts, ingest of nested/report/external files, sinks
* ``queries``    – the registered queries of ``__spark_entry__`` (stand-in data)
"""
