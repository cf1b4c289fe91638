"""Operators for preparing large-scale training corpora.

One module per operator; ``queries`` binds them to the driver tables. Nothing
else in the package imports this subpackage.
"""
