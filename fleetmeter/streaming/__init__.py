"""Structured Streaming jobs: files to bronze, bronze to silver, silver to gold."""
