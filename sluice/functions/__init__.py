"""Column functions: event envelope, cluster time, JSON text, record shapes."""
