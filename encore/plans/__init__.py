"""Composed plans: binding of the driver's tables and the end-to-end evaluation."""
