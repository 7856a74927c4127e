"""Composable Spark operators for building and curating a movie catalogue."""
