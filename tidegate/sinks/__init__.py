"""Writers: partitioned tables, current states, logs and the catalog."""
