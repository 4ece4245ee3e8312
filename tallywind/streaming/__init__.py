"""Structured Streaming sinks and the queries of the scoring job."""
