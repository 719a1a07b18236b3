"""Message and table sources, and the keyed store that is both source and sink."""
