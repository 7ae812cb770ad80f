"""Sources (Kafka, file replay) and catalog helpers (DDL, CTAS, views)."""
