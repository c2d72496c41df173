"""Complete jobs on raw files, and the catalog of checked queries."""
