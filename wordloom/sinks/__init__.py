"""Writers, and readers of what they wrote."""
