"""Operators for building language-model training corpora.

Ten operators over a ``documents`` table (doc_id, text, lang, source, n_chars).
Nothing outside this subpackage imports it; :mod:`foliospark.llm.queries`
registers one query for each operator.

Rules that hold for all of them: a null text counts as the empty text, extra
columns are ignored or passed through untouched, an empty table gives an empty
result with the same schema, and a row that occurs twice is handled twice
unless the operator's docstring says otherwise.
"""
