"""claimlens: a Spark-native claims-denial analytics warehouse.

Raw claim segments and beneficiary files become a star schema (patient,
provider, diagnosis and reason-code dimensions around a one-row-per-claim
fact), from which revenue-cycle KPIs and data-quality checks are computed.
Every model is a plain ``DataFrame -> DataFrame`` function; only sinks act.
"""

__version__ = "0.1.0"
