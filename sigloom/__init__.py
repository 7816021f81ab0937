"""sigloom: a PySpark-native engine for threat-intelligence document pipelines."""

__version__ = "0.1.0"
