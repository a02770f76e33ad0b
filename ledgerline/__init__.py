"""Subscription-billing analytics as plain Spark DataFrame code."""
