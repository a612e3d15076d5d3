"""PySpark engine for a multi-site book-review warehouse."""
