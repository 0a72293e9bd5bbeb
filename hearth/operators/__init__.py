"""DataFrame -> DataFrame operators of the listing jobs."""
