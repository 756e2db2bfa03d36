"""DataFrame → DataFrame operators: staging, dimensions, facts, merge, gaps."""
