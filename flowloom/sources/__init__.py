"""Reading binary flow captures.  header, decode, predicate, schema and library work without Spark."""
