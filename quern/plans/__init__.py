"""Registered queries (``registry``) and their SQL oracles (``oracle``)."""
