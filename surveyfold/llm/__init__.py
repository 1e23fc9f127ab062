"""Training-data operators: one module per operator, one query module for the registry.

``queries.py`` registers ``op1_...`` to ``op13_...``. Nothing
outside this subpackage imports it.
"""
