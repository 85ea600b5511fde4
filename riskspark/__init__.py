"""Environmental risk analytics and document evidence as PySpark jobs."""
