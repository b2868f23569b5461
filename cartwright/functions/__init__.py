"""Column expressions; nothing here triggers a job or needs a session."""
