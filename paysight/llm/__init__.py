"""Operators for preparing training text: language, quality, licences, language-model
scores, token counts, packing, near duplicates, decontamination, secrets and top-k search.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its queries when it is there.
"""
