"""playtrack: activity-and-injury analytics as lazy Spark DataFrame operators.

Subpackages: ``sources`` (readers, staging views, file sinks), ``functions``
(column expressions and category rule sets), ``operators`` (DataFrame ->
DataFrame steps), ``plans`` (the registered queries and their SQL oracles).
"""

__all__ = ["session", "sources", "functions", "operators", "plans"]
