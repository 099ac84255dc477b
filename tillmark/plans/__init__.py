"""Ways to run the operators: chart payloads, SQL views and the sync job."""
