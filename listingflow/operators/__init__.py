"""DataFrame operators: links, frontier, typing and validation, store, statistics, batching,
enrichment, rule-driven extraction and the full crawl job."""
