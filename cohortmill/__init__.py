"""cohortmill: clinical-registry analytics as composable Spark DataFrame operators."""
