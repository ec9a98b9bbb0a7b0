"""Column helpers and date windows."""
