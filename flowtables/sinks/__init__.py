"""Writers: topics, search-index bulk bodies, keyed files, tables."""
