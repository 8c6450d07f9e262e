"""Structured Streaming: message framing, stream scoring, stream cleaning."""
