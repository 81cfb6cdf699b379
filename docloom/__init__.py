"""docloom: a PySpark engine that turns captured documentation pages into a retrieval-ready index."""
