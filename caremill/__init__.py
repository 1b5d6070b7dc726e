"""Care analytics as Spark jobs: landing, history, coverage, revenue, checks and BI answers."""
