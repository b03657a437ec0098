"""Training-data operators (quality, toxicity, LM scores, near duplicates,
HTML text, packing, binary token files, secrets, decontamination).

Every operator is a DataFrame -> DataFrame function with its own module;
``queries.py`` holds the registered ``opN_*`` queries and ``oracle.py`` their
DuckDB twins. Nothing else in the library imports this package."""
