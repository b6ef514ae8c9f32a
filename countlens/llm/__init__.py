"""Operators of a training-data pipeline: deduplication, language and quality
scoring, decontamination, secret scanning, archives and mixing.

Nothing outside this subpackage imports it. Each module holds one operator,
built from Spark's partitioning, shuffles and joins; numpy runs inside tasks on
Arrow batches.
"""
