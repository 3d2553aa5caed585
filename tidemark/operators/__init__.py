"""DataFrame operators: shaping, incremental reads, change application, reconciliation."""
