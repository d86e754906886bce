"""Disruption analytics and alerting as Spark jobs: bronze, silver, gold and the jobs around them."""
