"""Training-data operators: quality, dedup, decontamination, packing, scoring.

Nothing else in the package imports this folder; ``__spark_entry__`` adds its
queries only when it can be imported.
"""
