"""Fleet statistics, monitors, replication and reconciliation as Spark DataFrame jobs."""
