"""Loading of files as they arrive."""
