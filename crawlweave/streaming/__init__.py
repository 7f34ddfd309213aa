"""The crawl event feed with Structured Streaming."""
