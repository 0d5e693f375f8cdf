"""Readers and writers: text ingest, JDBC range reads, partitioned and audited table writes."""
