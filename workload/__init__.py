"""The registered queries: fixtures derived from the test tables, and the SQL they must equal."""
