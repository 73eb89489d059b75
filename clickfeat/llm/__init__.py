"""Training-data operators: ten operators over a ``documents`` table and the
queries that apply them.  Nothing outside this subpackage imports it."""
