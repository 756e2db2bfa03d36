"""Urban trips and weather analytics as composable Spark DataFrame functions."""
