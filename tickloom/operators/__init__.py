"""DataFrame to DataFrame operators on price bars and symbol metadata."""
