"""Web-corpus analytics on Spark: crawl index, archives, page fields, text features, retrieval."""
