"""Network-security analytics on PySpark: flow records, IDS events, alerts, rules."""

__version__ = "0.1.0"
