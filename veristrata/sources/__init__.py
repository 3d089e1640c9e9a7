"""Reading tables and files, writing results, and the entity views."""
