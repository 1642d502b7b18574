"""Structured Streaming: decode messages, enrich flights, score and deliver."""
