"""Jobs, analyst queries and their registry."""
