"""The ready-made reports and their runner."""
