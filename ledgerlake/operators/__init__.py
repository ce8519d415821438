"""DataFrame -> DataFrame operators (all built from Spark SQL / DataFrame primitives)."""
