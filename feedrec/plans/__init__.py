"""Query registry, SQL twins and the batch jobs."""
