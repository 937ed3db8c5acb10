"""Source registry, file discovery, bronze rows, file ledger and table definitions."""
