"""Report tables and logs."""
