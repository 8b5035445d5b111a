"""Column expressions: text, names, titles, fields, terms and times. All of them run inside Spark's generated code."""
