"""Spark jobs for admission, treatment and insurance-claim feeds."""
