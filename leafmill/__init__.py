"""Web-content tables on Spark: pages, API responses, request logs and search as DataFrame operators."""
