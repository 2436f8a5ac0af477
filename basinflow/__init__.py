"""basinflow: river-flow forecasting samples and skill scores as Spark jobs.

Public entry points live in the sub-packages: ``sources`` (readers),
``operators`` (calendars, window fan-out, as-of join, recipes, gates,
scaling, metrics, ranking), ``functions`` (column helpers), ``sinks``
(writers), ``streaming`` (incremental builds) and ``plans`` (registered
queries with their SQL oracles).
"""

__version__ = "0.1.0"
