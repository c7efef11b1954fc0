"""Spark operators for fraud, churn, order, sensor and social-event analytics."""
