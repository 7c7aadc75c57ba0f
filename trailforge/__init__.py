"""trailforge: a PySpark-native engine for agent-trajectory and source-code corpora."""

__version__ = "0.1.0"
