"""Operators for preparing language-model training data at corpus scale.

Thirteen operators, one module each; ``queries`` registers one query per operator
and ``oracle`` holds the DuckDB twins of those that SQL can express. Nothing
outside this subpackage imports it except the entry module, behind a guard.
"""
