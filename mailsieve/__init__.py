"""Set-oriented e-mail triage, document preparation and retrieval analytics on PySpark."""

__version__ = "0.1.0"
