"""Operators for training-data pipelines (see the README's section on ``llm``).

Nothing outside this subpackage imports it; its queries are registered by
``threadscope.llm.queries``.
"""
