"""Operators for training-data pipelines: line, document and passage
deduplication, decontamination, token counts, toxicity, personal data,
vector search and source mixing.

Conventions shared by all operators:

* an operator reads only the columns that it names and gives internal columns
  a leading ``__``, so further columns of any name pass through or are ignored;
* a null text counts as an empty text;
* results are defined for empty tables (an empty result of the same schema)
  and for repeated rows (see each operator).
"""
