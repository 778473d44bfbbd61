"""The warehouse's own tables and jobs, made of the operators."""
