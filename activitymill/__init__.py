"""Developer-activity analytics as plain PySpark: facts, dimensions, marts, checks and a gated daily job."""
