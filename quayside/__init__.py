"""Object transfer, transfer metadata and log pipelines as Spark jobs."""
