"""DataFrame to DataFrame steps; lazy, no actions."""
