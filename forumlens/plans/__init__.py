"""The warehouse itself: staging, dimensions, facts, quality checks, marts and KPIs."""
