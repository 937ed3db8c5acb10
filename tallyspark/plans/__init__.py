"""Silver, gold and dashboard plans."""
