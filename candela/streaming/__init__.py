"""Structured Streaming jobs: article intake, rolling sentiment, live scoring."""
