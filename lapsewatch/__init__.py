"""Subscription-churn analytics as Spark DataFrame operators."""
