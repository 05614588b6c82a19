"""Spark-native annotation analytics: interval algebra, joins, segmentation, assignment, gates and reports."""
