"""Named queries of siteweave: plans over the test tables, with their SQL."""
