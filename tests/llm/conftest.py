"""The session of the other tests."""
