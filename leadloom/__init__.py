"""Trade-relationship and sales-lead analytics as Spark DataFrame operators."""
