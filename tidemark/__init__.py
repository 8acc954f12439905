"""Market analytics as Spark DataFrame operators.

Layers: ``sources`` (landed files in, tables out), ``functions`` (column
expressions), ``operators`` (DataFrame to DataFrame), ``plans`` (the staging
tables, marts, checks and reports composed from them) and ``streaming``.
"""
