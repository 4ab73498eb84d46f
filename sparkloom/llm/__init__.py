"""Operators of a training-data pipeline (chat formatting, dedup, decontamination, tokens, LM, ...).

Nothing outside this sub-package imports it; ``__spark_entry__.py`` adds its queries when present.
"""
