"""Jobs: operators wired from a source to a sink."""
