"""Named queries over the star-schema tables, and SQL that gives the same results."""
