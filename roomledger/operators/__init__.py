"""Reusable DataFrame operators. None of them starts a Spark job."""
