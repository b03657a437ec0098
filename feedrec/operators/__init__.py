"""DataFrame -> DataFrame operators of the four batch jobs."""
