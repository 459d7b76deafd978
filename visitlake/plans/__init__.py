"""The star schema, the batch job that builds it, and the questions asked of it."""
