"""Operators of a training-data pipeline (one module per operator).

Nothing outside this folder imports it.  Each module holds one operator with
its own general interface; :mod:`tidemark.llm.queries` applies the operators to
whole tables under the names ``op<N>_<name>``.
"""
