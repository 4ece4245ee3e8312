"""Whole jobs, composed of the operators. Each module runs under spark-submit."""
