"""Readers of crawl artifacts and payloads."""
