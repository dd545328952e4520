"""Multi-step jobs: crawl, refresh, strip, verify, decide, publish."""
