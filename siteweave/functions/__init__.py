"""Column builders of siteweave."""
