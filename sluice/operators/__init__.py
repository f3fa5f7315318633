"""DataFrame operators over encoded change events."""
