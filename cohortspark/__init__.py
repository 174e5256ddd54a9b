"""Patient-cohort snapshots over health-plan tables, written as Spark DataFrame jobs."""
