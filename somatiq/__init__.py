"""somatiq: Spark-native analytics for signals, events, questionnaires and text corpora."""

__version__ = "0.1.0"
