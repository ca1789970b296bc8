"""Message analytics as Spark jobs: staging, contact matching, message and conversation tables."""
