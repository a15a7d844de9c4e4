"""Operators for preparing training text: packing, de-duplication, extraction, filters.

Each module holds one operator with its own interface; ``queries`` registers one
thin query per operator. Nothing outside this package imports it.
"""
