"""Race-card analytics as Spark jobs: load feeds, enrich runners, train, decide."""
