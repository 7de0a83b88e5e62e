"""Relational operators: DataFrame in, DataFrame out, no actions unless the docstring names one."""
