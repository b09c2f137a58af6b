"""Multi-method detection and end-to-end jobs."""
