"""Column expressions: declared types, failure predicates, dates, prices."""
