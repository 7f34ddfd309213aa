"""DataFrame-to-DataFrame operators over crawl data."""
