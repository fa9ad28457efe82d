"""shelfcast: monthly supply-planning analytics as composable Spark DataFrame functions."""
