"""chirrup: social engagement analytics expressed as Spark DataFrame operators."""
