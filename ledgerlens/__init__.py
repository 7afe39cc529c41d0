"""An audit analytics engine on PySpark: checks, signals, reconciliation, gates, forecasts and retrieval."""
