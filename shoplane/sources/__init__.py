"""Source readers/writers (lake layout, CSV ingest) and driver test-data views."""
