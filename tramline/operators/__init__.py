"""DataFrame to DataFrame operators. They take column names and parameters, and neither a session nor table names."""
