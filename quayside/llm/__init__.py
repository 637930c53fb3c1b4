"""Training-data operators: mixing, top-k search, language ID, near-duplicates,
URL rules, chat formatting, sharding, PII surrogates, decontamination and
main-text extraction.  Nothing else in the library imports this package.
"""
