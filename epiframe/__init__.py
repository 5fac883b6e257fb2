"""epiframe: surveillance analytics as Spark DataFrame jobs.

Raw all-text case records are cleaned into typed, keyed tables (``plans.silver``),
checked and changed as table jobs (``operators``), read through standing views and
dashboard questions (``plans.views``, ``plans.dashboard``) and condensed into
statistics tables (``plans.gold``).
"""

__version__ = "0.1.0"
