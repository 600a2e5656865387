"""lexivane: paragraph-corpus, embedding and topic analytics as Spark jobs."""

__version__ = "0.1.0"
