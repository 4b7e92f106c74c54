"""Operators for training-data pipelines: search, language, licences, tokens, secrets, decontamination,
quality, chat formatting, web archives and near-duplicates.

Nothing else in the package imports this one.
"""
