"""Search routes, the document store and the query catalogue."""
