"""Operators for preparing training text at scale: tokenising, de-duplication, quality and
language models, decontamination, list filters. Nothing else in the library imports this."""
