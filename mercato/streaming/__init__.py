"""Late-event jobs on Structured Streaming."""
