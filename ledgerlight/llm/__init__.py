"""Training-data operators: packing, URL rules, mixing, near-duplicates, licences, language, extraction, quality.

Nothing outside this folder imports it; ``__spark_entry__.py`` adds its queries when it is present.
"""
