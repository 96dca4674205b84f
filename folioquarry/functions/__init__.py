"""Column functions: geometry, text and value coercion. All but two are Spark built-ins under the hood."""
