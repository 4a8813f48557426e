"""Captured web pages and their logs as a clean, versioned catalogue, on Spark."""
