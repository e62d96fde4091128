"""Training-data operators (mixing, scans, extraction, dedup, decontamination, language ID).

Nothing else in the library imports this subpackage.
"""
