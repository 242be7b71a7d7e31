"""Hoopline: game-log and betting-line analytics expressed as Spark DataFrame jobs."""
