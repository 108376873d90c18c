"""Marketplace order analytics as Spark DataFrame plans.

Layers, bottom up:

* ``functions``  column expressions (``Column -> Column``), no UDFs
* ``sources``    schemas, readers, table writers and the sample-table binding
* ``operators``  reusable DataFrame operators: latest-per-key, calendar, history, quality rules
* ``plans``      staging relations, roll-ups, marts, metrics, contracts and the pipeline
* ``streaming``  the status history fed by a stream
"""
