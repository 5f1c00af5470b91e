"""Operators of a large-scale training-data pipeline.

``QUERIES`` maps each registered query name to ``(spark, sf_dir) -> DataFrame`` and
``ORACLES`` maps the names that DuckDB can check to their SQL. Nothing outside this
subpackage imports it, but for the guarded hook in ``__spark_entry__.py``.
"""
