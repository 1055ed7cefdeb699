"""Raw-file ingest, the month-partitioned warehouse and the test-data views."""
