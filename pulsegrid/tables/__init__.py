"""Model registry and experiment log as plain, append-only Spark tables."""
