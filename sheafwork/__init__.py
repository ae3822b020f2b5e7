"""Composable PySpark jobs for layered (bronze, silver, gold) analytics tables."""
