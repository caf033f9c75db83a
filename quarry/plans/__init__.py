"""End-to-end plans over the supplied tables and the query registry."""
