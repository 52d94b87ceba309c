"""forumlens: a Spark-native analytics warehouse for question-and-answer communities.

Layers (raw, staging, warehouse, marts) are plain DataFrame functions; storage and
scheduling of work are left to Spark.
"""
