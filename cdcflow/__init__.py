"""Change-data synchronisation as DataFrame and Structured Streaming operators."""
