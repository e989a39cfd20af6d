"""Query plans over the tables: the graph projection, the catalogue of queries, and their SQL."""
