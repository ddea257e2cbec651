"""Named queries over the test tables, with an independent SQL text for each."""
