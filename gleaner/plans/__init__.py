"""Size checks and end-to-end builds."""
