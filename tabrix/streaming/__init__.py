"""Streaming use of fitted state: new rows arriving as a stream are encoded (stream-static
broadcast joins against the fitted lookups) and scored by an MLlib model."""
