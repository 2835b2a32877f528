"""News and product trend analytics as Spark DataFrame and Column functions."""
