"""Views over the test tables, registered queries with their oracles, and the whole pipeline."""
