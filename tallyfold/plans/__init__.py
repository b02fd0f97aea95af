"""Views over the tables and the catalogue of named queries."""
