"""Operators for preparing training corpora: near-duplicate search, line and
passage removal, page extraction, language identification, quality rules,
tokenisation, packing and URL filters. Nothing else in the package imports
this folder."""
