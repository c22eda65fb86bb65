"""Operators of a training-data pipeline, each over whole tables (see registry.py).

Nothing outside this package imports it; ``__spark_entry__.py`` adds its
queries when the package is present.
"""
