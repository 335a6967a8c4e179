"""Layered analytical tables on Spark: typed ingest, recoding, panels, fills, models, serving tables.

Every operator is a plain ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function built from native Spark expressions.
"""
