"""Batch analytics over social-media opinion text, written as Spark jobs."""
