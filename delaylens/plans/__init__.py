"""End-to-end jobs, TESTDATA adapters and the query catalogue."""
