"""Training-data pipeline operators (ten operators, their queries and SQL).

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries only when it can be imported.
"""
