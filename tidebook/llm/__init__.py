"""Operators for preparing language-model training text.

Nothing outside this subpackage imports it.  Each module holds one operator with a general
interface; ``queries`` applies them to the given tables with their production settings.
"""
