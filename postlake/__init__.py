"""postlake: social-post analytics on Spark (clean, score, self-train, ingest)."""

__version__ = "0.1.0"
