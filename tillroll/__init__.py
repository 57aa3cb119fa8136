"""tillroll: product-analytics and royalty-reconciliation reports as lazy Spark DataFrame operators.

Entry points: `tillroll.plans.reports` (the eight reports), `tillroll.operators` (their building blocks),
`tillroll.sources` (tables, report contracts, sinks), `tillroll.streaming` (incremental funnel) and
`tillroll.session.get_spark` (session defaults for scripts and tests).
"""

__version__ = "0.1.0"
