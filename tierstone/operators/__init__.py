"""DataFrame operators: every function is lazy and returns a DataFrame."""
