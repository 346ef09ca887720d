"""Operators for preparing training text at scale, each usable on its own.

Nothing else in the package imports this subpackage; ``__spark_entry__`` adds its queries when it is
present. :mod:`chronotape.llm.queries` binds the operators to the tables.
"""
