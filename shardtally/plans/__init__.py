"""The ready-made reports."""
