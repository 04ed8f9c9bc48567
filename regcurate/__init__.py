"""regcurate: register curation on Spark.

Lands yearly administrative-register extracts (whitelisted columns,
provenance, period) and builds curated research tables from them, with
row counts, covered periods and column-contract reports. Everything is a
DataFrame plan; see ``regcurate.plans`` for the tables and
``regcurate.catalog`` for the query catalogue.
"""

__all__ = ["catalog", "plans", "operators", "sources", "sinks", "streaming", "functions",
           "specs"]
