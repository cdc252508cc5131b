"""Part of siteweave."""
