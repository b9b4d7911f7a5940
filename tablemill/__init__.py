"""Spark jobs for moving, reducing, pseudonymising and checking warehouse tables."""
