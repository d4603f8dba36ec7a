"""Operators for preparing training text, images of the web and vectors at scale."""
