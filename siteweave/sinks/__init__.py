"""Published tables, feature collections and their description."""
