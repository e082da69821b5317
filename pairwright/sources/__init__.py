"""Readers and writers for products, truth pairs and results."""
