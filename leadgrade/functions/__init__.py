"""Pure column expressions; nothing in this package starts a Spark job."""
