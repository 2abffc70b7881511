"""Structured Streaming form of the station-hour demand fact."""
