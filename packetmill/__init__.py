"""Batch and streaming Spark jobs for a content-intake pipeline."""
