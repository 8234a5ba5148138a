"""Sources: the raw delivery log (Kafka or files) and the test-data adapter."""
