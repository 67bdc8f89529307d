"""Following the recent-changes feed with Structured Streaming."""
