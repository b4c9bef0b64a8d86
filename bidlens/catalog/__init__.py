"""Named queries over the test tables, with their checking SQL."""
