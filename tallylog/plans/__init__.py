"""Reports composed from the operators, the job surface, and the registry of queries."""
